"""Column → Column text functions, all built-in Spark expressions, null-safe and stream-safe."""
from functools import reduce

from pyspark.sql import Column, functions as F

from textsignal import config, vocab

# Java's \w, \s and \d cover ASCII only; posts are Unicode, so the classes are spelled out.
WORD = r"[\p{L}\p{N}_]"
SPACE = r"[\s\x0B\x1c-\x1f\x85\p{Z}]"
NONSPACE = r"[^\s\x0B\x1c-\x1f\x85\p{Z}]"
DIGIT = r"\p{Nd}"

# Time expressions worth extracting, in reporting order.
TEMPORAL_PATTERNS = [
    rf"{DIGIT}+{SPACE}+(?:years?|months?|weeks?|days?){SPACE}+(?:ago|of{SPACE}+(?:this|my))",
    rf"since{SPACE}+(?:{WORD}+{SPACE}+)?{DIGIT}{{4}}",
    rf"for{SPACE}+(?:the{SPACE}+(?:last|past){SPACE}+)?{DIGIT}+{SPACE}+(?:years?|months?|weeks?)",
]


def strip_urls(c):
    return F.regexp_replace(c, rf"http{NONSPACE}+|www\.{NONSPACE}+", "")


def strip_subreddits(c):
    return F.regexp_replace(c, rf"r/{WORD}+", "")


def strip_users(c):
    return F.regexp_replace(c, rf"u/{WORD}+", "")


def strip_markdown_links(c, links="remove"):
    """`links="keep_text"` keeps the anchor text; the default drops the whole link."""
    if links == "keep_text":
        return F.regexp_replace(c, r"\[([^\n]*?)\]\([^\n]*?\)", "$1")
    return F.regexp_replace(c, r"\[[^\n]*?\]\([^\n]*?\)", "")


def strip_markdown_symbols(c):
    return F.translate(c, vocab.MARKDOWN_SYMBOLS, "")


def strip_html_entities(c):
    return F.regexp_replace(c, rf"&{WORD}+;", "")


def squeeze_space(c):
    return F.trim(F.regexp_replace(c, rf"{SPACE}+", " "))


def strip_space(c):
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(c, rf"^{SPACE}+|{SPACE}+$", "")


def remove_noise(c, links="remove"):
    """Forum noise out: URLs, subreddit and user names, links, symbols, entities, extra space."""
    # Keeping the anchor text needs the link intact, so URLs go last in that mode.
    if links == "keep_text":
        c = strip_urls(strip_markdown_links(c, links))
    else:
        c = strip_urls(c)
    c = strip_users(strip_subreddits(c))
    if links != "keep_text":
        c = strip_markdown_links(c)
    return squeeze_space(strip_html_entities(strip_markdown_symbols(c)))


def strip_punctuation(c):
    return F.translate(c, vocab.PUNCTUATION, "")


def clean_deep(c, links="remove"):
    """Noise out, lower case, no ASCII punctuation. Gaps left by punctuation are not closed."""
    return strip_punctuation(F.lower(remove_noise(c, links)))


def is_blank(c):
    return F.length(strip_space(c)) == 0


def null_if_na(c):
    """Missing-value spellings to null, as a CSV round trip does."""
    return F.when(~c.isin(vocab.NA_TOKENS), c)


def tokenize(c, mode="word"):
    """Tokens of a text. `whitespace` splits on space only; `word` also splits contractions and curly quotes."""
    if mode == "word":
        c = split_contractions(F.regexp_replace(c, "([«“‘„»”’])", " $1 "))
    elif mode != "whitespace":
        raise ValueError(f"unknown tokenizer mode {mode!r}")
    return F.array_remove(F.split(c, rf"{SPACE}+"), "")


def split_contractions(c):
    # What stands before is looked at only behind the word: a pattern that begins with letters is searched much faster.
    for word, (left, right) in vocab.CONTRACTIONS.items():
        c = F.regexp_replace(c, rf"{word}(?<!{WORD}{word})(?!{WORD})", f"{left} {right}")
    return c


def word_list(words):
    """A word list as the caller holds it, without repeats, for use inside expressions. The expression carries
    every word; lists of more than some ten thousand words are better joined as tables."""
    return sorted(set(words))


def in_words(x, words):
    words = word_list(words)
    return x.isin(words) if words else F.lit(False)


def sql_text(s):
    """A string as a Spark SQL literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def keep_words(array_name, words):
    """Elements of a named array column that are in a word list. Thousands of literals are parsed at once
    here, where one call per literal would take seconds of driver time."""
    words = word_list(words)
    listed = ", ".join(sql_text(w) for w in words) or "NULL"
    return F.expr(f"filter(`{array_name}`, x -> coalesce(x IN ({listed}), false))")


def remove_stopwords(tokens, stopwords=vocab.STOPWORDS):
    return F.filter(tokens, lambda t: ~in_words(t, stopwords) & (F.length(t) > 1))


def features_tokens(c):
    """Word tokens of two or more characters, as count vectorisers take them."""
    return F.regexp_extract_all(F.lower(c), F.lit(rf"{WORD}{{2,}}"), F.lit(0))


def ngrams(tokens, n):
    """Adjacent n-grams inside one row, joined with a blank."""
    starts = F.when(F.size(tokens) >= n, F.sequence(F.lit(1), F.size(tokens) - (n - 1)))
    return F.coalesce(F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, n), " ")),
                      F.array().cast("array<string>"))


def grams_up_to(tokens, n):
    return tokens if n == 1 else F.concat(tokens, *[ngrams(tokens, m) for m in range(2, n + 1)])


def sentences(c):
    """Sentences with more than four words, stripped, in order."""
    parts = F.split(strip_space(c), rf"(?<=[.!?]){SPACE}+")
    return F.filter(F.transform(parts, strip_space),
                    lambda s: F.size(tokenize(s, "whitespace")) > config.MIN_SENTENCE_WORDS)


def head_chars(c, n):
    return F.substring(c, 1, n)


def head_words(c, n):
    return F.array_join(F.slice(tokenize(c, "whitespace"), 1, n), " ")


def head_tokens(tokens, n):
    return F.slice(tokens, 1, n)


def snippet(c, n=config.SNIPPET_CHARS):
    return F.translate(head_chars(c, n), "\n", " ")


def temporal_expressions(c):
    """All time expressions: by pattern first, then by position."""
    found = [F.regexp_extract_all(c, F.lit("(?i)" + p), F.lit(0)) for p in TEMPORAL_PATTERNS]
    return F.flatten(F.array(*found))


def sentiment_class(compound):
    return (F.when(compound >= config.POSITIVE_FROM, "positive")
            .when(compound <= config.NEGATIVE_TO, "negative")
            .otherwise("neutral"))


def lookup(x, table, default=None):
    """Literal dictionary lookup: one hash-set probe per distinct value of the table."""
    by_value = {}
    for word, value in table.items():
        by_value.setdefault(value, []).append(word)
    branches = [(x.isin(words), F.lit(value)) for value, words in by_value.items()]
    if not branches:
        return F.lit(default)
    first, rest = branches[0], branches[1:]
    case: Column = reduce(lambda acc, b: acc.when(*b), rest, F.when(*first))
    return case.otherwise(F.lit(default))


def part_of_speech(token, known_tag, function_words=vocab.STOPWORDS):
    """Lexicon tag if there is one, else a tag from the word's shape. Endings are compared as strings; a
    regular expression per token would cost several times as much."""
    tag = F.when(in_words(token, function_words), vocab.FUNCTION_WORD_TAG)
    tag = tag.when(F.translate(token, "0123456789", "") == "", vocab.NUMBER_TAG)
    for value, endings in vocab.SUFFIX_TAGS:
        tag = tag.when(reduce(lambda a, b: a | b, [token.endswith(e) for e in endings]), value)
    plural = token.endswith("s") & ~token.endswith("ss") & (F.length(token) > 1)
    return F.coalesce(known_tag, tag.when(plural, vocab.PLURAL_TAG).otherwise(vocab.DEFAULT_TAG))


def is_adjective_or_noun(tag):
    # One use of the tag, so that its rules run once.
    return F.substring(tag, 1, 2).isin("JJ", "NN")


def keep_adjectives_and_nouns(tokens, tags, function_words=vocab.STOPWORDS):
    """Tokens tagged JJ* or NN*, from a token → tag dictionary with word-shape defaults, inside the row."""
    return F.filter(tokens, lambda t: is_adjective_or_noun(part_of_speech(t, lookup(t, tags), function_words)))


def row_hash(seed, *cols):
    """Reproducible pseudo-random key of a row, the same in any SQL engine with md5."""
    return F.md5(F.concat_ws("-", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))
