"""SQL fragments for the statements that the registered queries are checked against."""
from textsignal import vocab
from textsignal.functions import stemming
from textsignal.functions.text import NONSPACE, SPACE, WORD

DIGIT = r"\p{Nd}"


def lit(s):
    return "'" + s.replace("'", "''") + "'"


def in_list(words):
    return "(" + ", ".join(lit(w) for w in words) + ")"


def values(rows):
    one = lambda v: lit(v) if isinstance(v, str) else f"{v}::DOUBLE" if isinstance(v, float) else str(v)
    return "(VALUES " + ", ".join("(" + ", ".join(one(v) for v in r) + ")" for r in rows) + ")"


def drop(c, pattern, by=""):
    return f"regexp_replace({c}, {lit(pattern)}, {lit(by)}, 'g')"


def noise(c):
    c = drop(c, rf"http{NONSPACE}+|www\.{NONSPACE}+")
    c = drop(drop(c, rf"r/{WORD}+"), rf"u/{WORD}+")
    c = drop(c, r"\[[^\n]*?\]\([^\n]*?\)")
    c = f"translate({c}, {lit(vocab.MARKDOWN_SYMBOLS)}, '')"
    c = drop(c, rf"&{WORD}+;")
    return f"trim({drop(c, SPACE + '+', ' ')})"


def deep(c):
    return f"translate(lower({noise(c)}), {lit(vocab.PUNCTUATION)}, '')"


def strip(c):
    return drop(c, rf"^{SPACE}+|{SPACE}+$")


def tokens(c):
    return f"list_filter(string_split_regex({c}, {lit(SPACE + '+')}), lambda x: x <> '')"


def word_tokens(c):
    c = drop(c, "([«“‘„»”’])", r" \1 ")
    for word, (a, b) in vocab.CONTRACTIONS.items():
        c = drop(c, rf"\b{word}\b", f"{a} {b}")
    return tokens(c)


def kept(tokens_expr, stopwords=vocab.STOPWORDS):
    return f"list_filter({tokens_expr}, lambda x: x NOT IN {in_list(stopwords)} AND length(x) > 1)"


def feature_tokens(c):
    return f"regexp_extract_all(lower({c}), {lit(WORD + '{2,}')})"


def sentences(c):
    marked = drop(strip(c), rf"([.!?]){SPACE}+", "\\1\x01")
    parts = f"list_transform(string_split({marked}, chr(1)), lambda s: {strip('s')})"
    return f"list_filter({parts}, lambda s: len(list_filter(string_split_regex(s, {lit(SPACE + '+')}), lambda w: w <> '')) > 4)"


def bigrams(tk):
    return (f"list_transform(range(1, len({tk})), lambda i: {tk}[i] || ' ' || {tk}[i + 1])")


def _shape(c):
    return f"replace(regexp_replace({c}, '([^aeiouy])y', '\\1i', 'g'), 'yy', 'yi')"


def _turns(c, times):
    return f"regexp_matches({_shape(c)}, '{stemming.ONE_TURN if times == 1 else stemming.TWO_TURNS}')"


def _short(c):
    return f"(regexp_matches({_shape(c)}, '{stemming.SHORT_END}') AND right({c}, 1) <> 'y')"


def _less(c, n):
    return f"left({c}, length({c}) - {n})"


def stems(words):
    """CTEs that end in stemmed(token, stem) for the words of the CTE `words`(token): one step of the algorithm each."""
    has_vowel = lambda c: f"regexp_matches({_shape(c)}, '[aeiou]')"
    double = f"(length(b) > 1 AND right(b, 1) = left(right(b, 2), 1) AND NOT regexp_matches({_shape('b')}, '[aeiou]$'))"
    mended = (f"CASE WHEN regexp_matches(b, '(at|bl|iz)$') THEN b || 'e' WHEN {double} AND right(b, 1) NOT IN ('l', 's', 'z') THEN {_less('b', 1)} "
              f"WHEN {_turns('b', 1)} AND NOT {_turns('b', 2)} AND {_short('b')} THEN b || 'e' ELSE b END")
    ending = lambda suffixes: lit(f"({'|'.join(suffixes)})$")
    ctes = [f"st0 AS (SELECT DISTINCT token, lower(token) AS w FROM {words})",
            f"st1 AS (SELECT token, CASE WHEN regexp_matches(w, '(sses|ies)$') THEN {_less('w', 2)} WHEN regexp_matches(w, '[^s]s$') THEN {_less('w', 1)} ELSE w END AS w FROM st0)",
            "st2a AS (SELECT *, CASE WHEN w LIKE '%eed' THEN NULL WHEN w LIKE '%ed' THEN left(w, length(w) - 2) WHEN w LIKE '%ing' THEN left(w, length(w) - 3) END AS b FROM st1)",
            f"st2 AS (SELECT token, CASE WHEN w LIKE '%eed' THEN CASE WHEN {_turns(_less('w', 3), 1)} THEN {_less('w', 1)} ELSE w END WHEN b IS NOT NULL AND {has_vowel('b')} THEN {mended} ELSE w END AS w FROM st2a)",
            f"st3 AS (SELECT token, CASE WHEN w LIKE '%y' AND {has_vowel(_less('w', 1))} THEN {_less('w', 1)} || 'i' ELSE w END AS w FROM st2)"]
    for i, table in ((4, stemming.STEP_2), (5, stemming.STEP_3)):
        cases = " ".join(f"WHEN {lit(s)} THEN {lit(new)}" for s, new in table)
        ctes += [f"st{i}a AS (SELECT *, regexp_extract(w, {ending(s for s, _ in table)}, 1) AS s FROM st{i - 1})",
                 f"st{i} AS (SELECT token, CASE WHEN s <> '' AND {_turns(_less('w', 'length(s)'), 1)} THEN {_less('w', 'length(s)')} || CASE s {cases} END ELSE w END AS w FROM st{i}a)"]
    base = _less("w", "length(s)")
    ctes += [f"st6a AS (SELECT *, regexp_extract(w, {ending(stemming.STEP_4)}, 1) AS s FROM st5)",
             f"st6 AS (SELECT token, CASE WHEN s <> '' AND (s <> 'ion' OR regexp_matches({base}, '[st]$')) AND {_turns(base, 2)} THEN {base} ELSE w END AS w FROM st6a)",
             f"st7 AS (SELECT token, CASE WHEN w LIKE '%e' AND ({_turns(_less('w', 1), 2)} OR {_turns(_less('w', 1), 1)} AND NOT {_short(_less('w', 1))}) THEN {_less('w', 1)} ELSE w END AS w FROM st6)",
             f"stemmed AS (SELECT token, CASE WHEN length(token) <= 2 THEN lower(token) WHEN w LIKE '%ll' AND {_turns('w', 2)} THEN {_less('w', 1)} ELSE w END AS stem FROM st7)"]
    return ",\n".join(ctes)
