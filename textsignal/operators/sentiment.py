"""Rule-based sentiment from a valence lexicon (Hutto & Gilbert 2014).

Two forms with equal results. `score` works inside the row: no shuffle, works on streams, takes the
lexicon as a dictionary. `score_by_join` takes a lexicon table of any size.
"""
from pyspark.sql import functions as F

from textsignal import vocab
from textsignal.functions import text as X
from textsignal.operators import dictionary
from textsignal.operators.bounds import bind

SCORE_COLUMNS = ["compound", "pos", "neg", "neu"]


def _degree(word):
    return (F.when(X.in_words(word, vocab.BOOSTERS), vocab.BOOST)
            .when(X.in_words(word, vocab.DAMPENERS), -vocab.BOOST).otherwise(0.0))


def _is_degree(word):
    return X.in_words(word, vocab.BOOSTERS + vocab.DAMPENERS)


def _negated(word):
    return F.coalesce(X.in_words(word, vocab.NEGATIONS), F.lit(False))


def _is(word, *values):
    return F.coalesce(word.isin(*values), F.lit(False))


def _factor(d, p1, p2, p3):
    """Effect of a negation at distance d, given the words at distances 1 to 3."""
    if d == 1:
        return F.when(_negated(p1), vocab.NEGATION_FACTOR).otherwise(1.0)
    if d == 2:
        emphatic = _is(p2, "never") & _is(p1, "so", "this")
        sure = _is(p2, "without") & _is(p1, "doubt")
        word = p2
    else:
        emphatic = (_is(p3, "never") & _is(p2, "so", "this")) | _is(p1, "so", "this")
        sure = _is(p3, "without") & (_is(p2, "doubt") | _is(p1, "doubt"))
        word = p3
    return (F.when(emphatic, vocab.EMPHATIC_NEVER).when(sure, 1.0)
            .when(_negated(word), vocab.NEGATION_FACTOR).otherwise(1.0))


def _shift(v, d, word, in_lexicon, p1, p2, p3):
    """Valence after looking at the word at distance d; lexicon words do not modify their neighbours."""
    push = _degree(word) * vocab.DISTANCE_DAMPING[d]
    moved = (v + F.when(v < 0, -push).otherwise(push)) * _factor(d, p1, p2, p3)
    return F.when(word.isNull() | in_lexicon, v).otherwise(moved)


def _start(base, word, following_in_lexicon, p1, p2, p3):
    """Lexicon valence, turned round by a preceding `no`; `no` itself counts only when it stands alone."""
    negated = _is(p1, "no") | _is(p2, "no") | (_is(p3, "no") & _is(p1, "or", "nor"))
    return (F.when(negated, base * vocab.NEGATION_FACTOR)
            .when((word == "no") & following_in_lexicon, 0.0).otherwise(base))


def _phrase(v, word, in_lexicon, p1, p2, p3, n1, n2, idioms, pairs):
    """Idioms around a word replace its valence; two-word dampeners before it take from it whatever its sign. As published,
    both are looked up only if a word outside the lexicon stands three places before."""
    said = lambda *ws: F.concat(*[x for w in ws for x in (F.lit(" "), w)][1:])
    found = [(said(word, n1, n2)), said(word, n1), said(p1, word), said(p2, p1, word), said(p2, p1), said(p3, p2, p1), said(p3, p2)]
    value = F.coalesce(*[X.lookup(p, idioms) for p in found], v) if idioms else v
    for p in (said(p3, p2), said(p2, p1)):
        value = value - F.when(F.coalesce(X.in_words(p, pairs), F.lit(False)), vocab.BOOST).otherwise(0.0)
    return F.when(p3.isNull() | in_lexicon, v).otherwise(value)


def _least(v, p1, p1_in_lexicon, p2):
    """`least` turns a word round, except in `at least` and `very least`."""
    turned = _is(p1, "least") & ~p1_in_lexicon & ~_is(p2, "at", "very")
    return F.when(turned, v * vocab.NEGATION_FACTOR).otherwise(v)


def _but_weight(pos, but_at):
    return (F.when(but_at.isNull() | (pos == but_at), 1.0)
            .when(pos < but_at, vocab.BEFORE_BUT).otherwise(vocab.AFTER_BUT))


def _scores(total, pos_sum, neg_sum, neu, n):
    """Final columns from the sums over a post; an empty post scores 0 everywhere."""
    whole = pos_sum + F.abs(neg_sum) + neu
    share = lambda x: F.when(n > 0, F.round(x / whole, 3)).otherwise(0.0)
    compound = F.round(total / F.sqrt(total * total + vocab.COMPOUND_ALPHA), 4)
    return {"compound": F.when(n > 0, compound).otherwise(0.0), "pos": share(pos_sum),
            "neg": share(F.abs(neg_sum)), "neu": share(neu)}


def _score_rows(df, base, listed, prefix, idioms, pairs):
    """Scores from a row's `_tokens`. base(word, i) is the valence of the word at i, listed(i) whether the word there has one; the rule
    chain runs only on words that have."""
    tokens = F.col("_tokens")
    # A one-element array binds the running value, so that each step names it instead of repeating it.
    then = lambda v, step: F.get(F.transform(F.array(v), step), F.lit(0))

    def valence(word, i):
        near = [F.get(tokens, i - d) for d in (1, 2, 3)]
        p1, p2, p3 = near
        v = _start(base(word, i), word, listed(i + 1), p1, p2, p3)
        for d, p in zip((1, 2, 3), near):
            v = then(v, lambda x: _shift(x, d, p, listed(i - d), p1, p2, p3))
        n1, n2 = F.get(tokens, i + 1), F.get(tokens, i + 2)
        v = then(v, lambda x: _phrase(x, word, listed(i - 3), p1, p2, p3, n1, n2, idioms, pairs))
        v = then(v, lambda x: _least(x, p1, listed(i - 1), p2))
        counts = listed(i) & ~_is_degree(word) & ~((word == "kind") & _is(F.get(tokens, i + 1), "of"))
        return F.when(counts, v * _but_weight(i, F.col("_but"))).otherwise(0.0)

    add = lambda arr: F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)
    values = F.col("_values")
    scored = (df.withColumn("_but", F.when(F.array_contains("_tokens", "but"), (F.array_position("_tokens", "but") - 1).cast("int")))
              .transform(lambda t: bind(t, _values=F.transform("_tokens", valence)))
              .withColumns({
                  "_total": add(values),
                  "_pos": add(F.transform(F.filter(values, lambda v: v > 0), lambda v: v + 1)),
                  "_neg": add(F.transform(F.filter(values, lambda v: v < 0), lambda v: v - 1)),
                  "_neu": F.size(F.filter(values, lambda v: v == 0)).cast("double"),
                  "_n": F.size(values)}))
    out = _scores(*[F.col(c) for c in ("_total", "_pos", "_neg", "_neu", "_n")])
    scored = scored.withColumns({prefix + k: v for k, v in out.items()})
    return (scored.withColumn(prefix + "sentiment", X.sentiment_class(F.col(prefix + "compound")))
            .drop("_tokens", "_but", "_values", "_total", "_pos", "_neg", "_neu", "_n"))


def score(df, lexicon, text="text_clean_deep", prefix="vader_", idioms=vocab.IDIOMS, pairs=vocab.DAMPENER_PAIRS):
    """Add compound, pos, neg, neu and the sentiment class, computed within each row.

    `lexicon` maps token → valence, `idioms` maps phrase → valence, `pairs` lists two-word dampeners. Membership is one hash probe per token.
    """
    tokens = bind(df, _tokens=X.tokenize(F.col(text), "whitespace"))
    listed = lambda i: F.coalesce(X.in_words(F.get(F.col("_tokens"), i), lexicon), F.lit(False))
    return _score_rows(tokens, lambda word, i: X.lookup(word, lexicon), listed, prefix, idioms, pairs)


def score_by_join(df, id_col, lexicon, text="text_clean_deep", prefix="vader_", idioms=vocab.IDIOMS, pairs=vocab.DAMPENER_PAIRS):
    """Same scores as (id, ...) rows, from a (token, valence) table of any size with one row per token."""
    tokens = df.select(id_col, X.tokenize(F.col(text), "whitespace").alias("_tokens"))
    known = dictionary.add_values(tokens, "_tokens", lexicon, "valence", "_known")
    listed = lambda i: F.get(F.col("_known"), i).isNotNull()
    return _score_rows(known, lambda word, i: F.get(F.col("_known"), i), listed, prefix, idioms, pairs).drop("_known")
