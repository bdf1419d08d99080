"""Operator defaults, all overridable at the call site."""

# These settings decide the results and must not drift.
SEED = 42
TEST_SIZE = 0.15
VAL_SIZE = 0.15
MAX_FEATURES = 10_000
LDA_TOPICS = 10
LDA_WORDS = 8
LDA_PASSES = 10
LDA_MIN_DF = 5
LDA_MAX_DF = 0.5
W2V_SIZE = 300
W2V_WINDOW = 5
W2V_MIN_COUNT = 3
W2V_EPOCHS = 10
TOP_K = 10
OVERFETCH = 3
IVF_CELLS = 100
# Of the 10 nearest of every 20th vector of sf0.1, 40 cells hold 0.93, 36 hold 0.89, 8 hold 0.47.
IVF_PROBES = 40
# Bytes of a vector's code, rows that the codebooks are fitted on, share of the cells whose codes are read, full vectors read
# for each hit asked for. Of the 10 nearest of every 20th vector this finds 0.96 (500 rows), 0.97 (2,000), 0.95 (10,000).
CODE_GROUPS = 16
CODE_PROBES = 0.8
CODE_SAMPLE = 65_536
CODE_SHORT = 5
BM25_K1 = 1.5
BM25_B = 0.75
BM25_EPSILON = 0.25
POSITIVE_FROM = 0.05
NEGATIVE_TO = -0.05
SNIPPET_CHARS = 200
SUMMARY_SENTENCES = 3
SUMMARY_MIN_WORDS = 50
POSTS_PER_CLUSTER = 20
MIN_SENTENCE_WORDS = 4

# A side is broadcast only after it was shown to hold at most this many rows.
BROADCAST_ROWS = 50_000
# Rows that look up their tokens together in a table too large for every task.
PART_ROWS = 512
# Documents of the topic model that meet its table together, if there are so many for every core.
LDA_PART_ROWS = 131_072
# Rows whose pairs of words are counted together; pairs of a block of the matrix, for vectors of W2V_SIZE (more for shorter ones).
PAIR_ROWS = 4_096
PAIR_BLOCK = 4_000_000
# Characters of the texts whose n-grams a task counts.
HASHED_CHARS = 4_000_000
# Query vectors scored per pass over the corpus.
QUERY_BLOCK = 4_096
# Documents of a shard of the keyword index; bounds a posting row.
SHARD_DOCS = 16_384
# Query terms that meet one copy of a shard's posting rows.
TERM_BLOCK = 65_536
