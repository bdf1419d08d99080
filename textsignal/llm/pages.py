"""Main text of web pages, with the help of a style tree for each site.

The pages of a host are merged into one tree: a node is a path of tags with their classes. Each node's content is
weighed by entropy over the pages that have it: a text found on every page tells nothing (importance 0), one found
on a single page tells most (1); its presentation by the variety of child sequences. Branches whose content and
presentation both stay low are removed from every page of the host. Elements that declare what they are (navigation,
forms, adverts, comments) go by their tags and classes, which also serves hosts with too few pages for statistics.
"""
import html
import re
from collections import Counter
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from textsignal.llm.common import slices, written
from textsignal.operators.bounds import small_side

# Branches below this importance go, if at least so many different pages of the host have them.
IMPORTANCE, MIN_PAGES = 0.2, 5
# Elements nested deeper share the node of this depth.
MAX_DEPTH = 40

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?:svg|math|object)\b(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+(?<=/)>"
    r"|<(script|style|noscript|template|textarea|select|svg|iframe|object|math|title)\b(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S | re.I)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/>]|$)""", re.I)
# Element classes of the markup language, and names that sites give to what is not the article.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set("address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
            "header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}
NOISE_TAGS = set("nav footer aside form head button dialog menu label input".split())
NOISE_NAMES = set("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation breadcrumb "
                  "breadcrumbs sidebar footer masthead cookie cookies consent gdpr notice notices popup modal newsletter subscribe subscription share "
                  "sharing social related recommended comment comments reply replies respond disqus widget toolbar pagination pager login signup "
                  "search skip hidden contentinfo complementary".split())
# A name after one of these tells what an element has or lacks, not what it is.
HAVING = set("no not non without with has hide".split())
HEADER_NAMES = set("header topbar".split())
MAIN_TAGS = ("article", "main")


class Block:
    """One run of text: its path, whether it counts as noise by its own account, whether it lies in the declared main part."""
    __slots__ = ("path", "noise", "main", "parts")

    def __init__(self, path, noise, main):
        self.path, self.noise, self.main, self.parts = path, noise, main, []

    def text(self):
        return " ".join("".join(self.parts).split())


def _noise_names(value, whole):
    """Noise names in a class, id or role; whole ones only, or between any signs."""
    for name in value.split():
        tokens = [t for t in re.split(r"[^a-z0-9]+", name) if t]
        if not whole or len(tokens) == 1:
            yield from (t for before, t in zip([""] + tokens, tokens) if t in NOISE_NAMES and before not in HAVING)


def parse(source):
    """Blocks in page order, and (path, child tags) of every element.

    A name or a form does not condemn the branch with most of the page's text; what is inside is judged by its own marks.
    """
    blocks, styles, amount = _parse(source, frozenset())
    most = {i for i, n in amount.items() if i and 2 * n > amount[0]}
    return _parse(source, most)[:2] if most else (blocks, styles)


def _parse(source, pardoned):
    """Blocks, styles, and characters of text in all and in each element, by its number, that a name or a form condemns."""
    stack = [["", "", False, False, [], (0,)]]  # tag, path, noise, main, child tags, elements to count for
    blocks, styles, at, number = [], [], 0, 0
    amount = {0: 0}
    current, opened = None, Counter()

    def close():
        tag, path, _, _, children, _ = stack.pop()
        opened[tag] -= 1
        if children:
            styles.append((path, " ".join(children)))
        return tag in BLOCK

    def add(text):
        nonlocal current
        if not text:
            return
        for i in stack[-1][5]:
            amount[i] += len(text.strip())
        if current is None:
            _, path, noise, main, *_ = next(e for e in reversed(stack) if e[0] in BLOCK or not e[0])
            current = Block(path, noise or stack[-1][2], main)
            blocks.append(current)
        if not stack[-1][2] or current.noise:
            current.parts.append(html.unescape(text))

    for m in TOKEN.finditer(source):
        add(source[at:m.start()])
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if m[2]:
            depth = opened[tag] and next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
            if depth:
                while len(stack) > depth:
                    if close():
                        current = None
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in BLOCK:
            current = None
            shut, scope = (CLOSES[tag], SCOPES[tag]) if tag in CLOSES else ((), ())
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in scope or tag not in CLOSES and stack[i][0] in BLOCK and stack[i][0] != "p":
                    break
                if stack[i][0] in shut or stack[i][0] == "p":
                    while len(stack) > i:
                        close()
                    if stack[i - 1][0] in scope or not shut:
                        break
        if tag in VOID:
            continue
        names, own, hidden = [], False, False
        for name, *values in ATTRIBUTE.findall(m[4]) if m[4] else ():
            value, name = "".join(values).lower(), name.lower()
            if name in ("hidden", "aria-hidden"):
                hidden |= value != "false"
            elif name == "style":
                hidden |= "display:none" in value.replace(" ", "")
            else:
                tokens = re.split(r"[^a-z0-9]+", value)
                names += tokens
                if not NOISE_NAMES.isdisjoint(tokens):
                    own |= tag not in ("html", "body", "main") and any(_noise_names(value, tag == "article"))
        _, path, noise, main, children, counted = stack[-1]
        number += 1
        children.append(tag)
        # Outer elements are not headers by a name.
        head = tag == "header" or names and not HEADER_NAMES.isdisjoint(names) and tag not in ("html", "body", *MAIN_TAGS)
        soft = own or tag == "form"
        if hidden or tag in NOISE_TAGS and tag != "form" or not main and head:
            noise, counted = True, ()
        elif soft and counted:
            counted = (*counted, number)
            amount[number] = 0
        noise = noise or soft and number not in pardoned
        main = main or not noise and (tag in MAIN_TAGS or "main" in names)
        if len(stack) <= MAX_DEPTH:
            path = f"{path}/{tag}" + "".join(f".{n}" for n in sorted(set(names)) if n and not n.isdigit())
        stack.append([tag, path, noise, main, [], counted])
        opened[tag] += 1
    add(source[at:])
    while len(stack) > 1:
        close()
    return blocks, styles, amount


def host(url):
    """Lower-cased host of an address; '' for null or unusable ones."""
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def _h(*parts):
    from xxhash import xxh64_intdigest
    return np.uint64(xxh64_intdigest("\x1f".join(parts).encode())).astype("int64")


def extract(source, low=frozenset()):
    """Main text of one page: blocks joined by line ends, without those that are noise or lie in a low branch.

    Inside a declared main part only named branches can be low: plain paragraphs there are the article, even where most
    pages of a host are near copies of each other.
    """
    blocks, _ = parse(source or "")
    kept = [b for b in blocks if not b.noise and not (low and any(_h(p) in low for p in _branches(b.path) if not b.main or "." in p.rsplit("/", 1)[1]))]
    main = [t for b in kept if b.main and (t := b.text())]
    return "\n".join(main or [t for b in kept if (t := b.text())])


def _branches(path):
    """The path and those above it, without the page's outermost elements."""
    parts = path.split("/")
    return ["/".join(parts[:i]) for i in range(4, len(parts) + 1)]


def _features(batches):
    """(host, path, kind, feature, page) of each page: content by text, presentation by child tags, and one row for the page itself."""
    for whole in batches:
        for batch in slices(whole, 4 << 20, "html"):
            rows = []
            for url, source in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()):
                site = host(url)
                if not site or not source:
                    continue
                blocks, styles = parse(source)
                page = set()
                for b in blocks:
                    if not b.noise and (t := b.text()):
                        page.update((_h(p), 0, _h(t)) for p in _branches(b.path))
                page.update((_h(p), 1, _h(s)) for p, s in styles if p.count("/") >= 3)
                rows += [(_h(site), *row, _h(source)) for row in page | {(r[0], 2, 0) for r in page}]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                                             names=["site", "path", "kind", "feature", "page"])


def low_branches(pages):
    """(site, path) hashes of the branches that every page of a host should lose.

    Copies of a page count once. Counts come first by feature, so a host with a third of all pages is summed up before it is moved.
    """
    features = pages.select("url", "html").mapInArrow(_features, "site long, path long, kind int, feature long, page long")
    counts = features.distinct().groupBy("site", "path", "kind", "feature").count()
    n = F.col("count").cast("double")
    pick = lambda kind, value: F.sum(F.when(F.col("kind") == kind, value).otherwise(0.0))
    nodes = counts.groupBy("site", "path").agg(
        pick(2, n).alias("m"), pick(0, n).alias("texts"), pick(0, n * F.log(n)).alias("spread"),
        pick(1, n).alias("styles"), pick(1, n * F.log(n)).alias("alike"))
    content = F.when(F.col("texts") > 0, 1 - F.col("spread") / F.col("texts") / F.log("m")).otherwise(0.0)
    # Entropy of the child sequences in the base of the number of pages.
    looks = F.when(F.col("styles") > 0, (F.log("styles") - F.col("alike") / F.col("styles")) / F.log("m")).otherwise(0.0)
    return nodes.filter((F.col("m") >= MIN_PAGES) & (F.greatest(content, looks) < IMPORTANCE)).select("site", "path")


def main_text(pages):
    """(page_id, url, text, n_chars) for each row: main text of the whole html; null or empty html has none.

    Rows with a null or unusable address are judged by their own marks alone. Repeated rows come out alike. Low branches
    are broadcast only if they are few; else pages are joined to them by host, and a large host can be split.
    """
    low = written(low_branches(pages), "low").groupBy("site").agg(F.collect_set("path").alias("low"))
    site = pages.select("page_id", "url", "html").mapInArrow(_with_site, "page_id long, url string, html string, site long")
    return site.join(small_side(written(low, "sites")), "site", "left").select("page_id", "url", "html", "low").mapInArrow(
        _extracted, "page_id long, url string, text string, n_chars long")


def _with_site(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "url", "html")), pa.array([_h(host(u)) for u in batch.column("url").to_pylist()], pa.int64())],
                                         names=["page_id", "url", "html", "site"])


def _extracted(batches):
    for whole in batches:
        for batch in slices(whole, 4 << 20, "html"):
            texts = [extract(s, frozenset(low or ())) for s, low in zip(batch.column("html").to_pylist(), batch.column("low").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])
