"""Main text of web pages by maximum-scoring subsequence.

A page is a sequence of words and tags. Words score positive, unless an
enclosing element is known to hold boilerplate, and tags negative; one linear
scan finds the contiguous region with the largest sum. Boilerplate between
two parts of a text is skipped at no cost, so it does not part them, and a word
of other boilerplate costs at most what a word of text gives. The weights of the
elements are learned from labelled pages, those whose markup names their
article; where the pages do not tell, the fixed priors below decide.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from basketlens.llm.common import slices

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea svg iframe object canvas select annotation".split())
#: elements of other vocabularies, which a slash at the end of the tag closes
FOREIGN = frozenset(["svg", "math"])
FORMULA = frozenset("math mfrac mi mn mo mover mrow ms msqrt mroot mspace mstyle msub msubsup msup mtable mtd mtext mtr munder "
                    "munderover semantics".split())
INLINE = FORMULA | frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
#: elements that parts of a running text are in; what holds these holds the text
FLOW = INLINE | frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table tbody thead tfoot tr td th figure "
                          "figcaption".split())
_CLOSED_BY = {"p": frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
                             "header hr main menu nav ol p pre section table ul".split()),
              "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
              "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]),
              "option": frozenset(["option"])}
#: elements and parts of class, id and role names that hold boilerplate unless labelled pages tell otherwise
BOILERPLATE_TAGS = frozenset("nav footer header aside form button menu dialog head title".split())
BOILERPLATE_NAMES = frozenset("ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie cookies "
                              "consent disclaimer footer header menu modal nav navbar navigation newsletter notice popup promo "
                              "related reply replies respond share sharing sidebar signup social sponsor sponsored subscribe "
                              "widget".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
                    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|([^<]+|<)", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME = re.compile(r"[a-z]+")


class Element:
    __slots__ = ("keys", "parent", "tag")

    def __init__(self, tag: str, parent: Element | None, keys: tuple[str, ...]):
        self.tag, self.parent, self.keys = tag, parent, keys


def _keys(tag: str, attributes: str) -> tuple[str, ...]:
    """What an element is known by: its name, alone if it has no class or id,
    and each word of its class, id and role with its name."""
    found = _ATTRIBUTE.findall(attributes) if "=" in attributes else []
    out = []
    for name, a, b, c in found:
        value = (a or b or c)
        out += [f"{tag}#{name.lower()}={value}"] if name.lower() == "itemprop" else \
            [f"{tag}.{x}" for x in _NAME.findall(value.lower())]
    return (*out, tag) if tag not in ("div", "section", "span") or not out else tuple(out)


def parse(page: str) -> Iterator[tuple[str, Element, str]]:
    """``("text", element, decoded text)`` and ``("tag", element, name)`` in
    page order; elements form the tree that the tags imply. Comments and the
    content of scripts, styles and the like give nothing. Unclosed elements
    end with their parent, closing tags without an opening one are skipped."""
    here = Element("", None, ())
    depth: Counter[str] = Counter()
    at = 0
    while m := _TOKEN.match(page, at):
        at = m.end()
        text = m[7]
        if text is not None:
            yield "text", here, html.unescape(text)
            continue
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            if depth[tag]:
                while here.tag != tag:
                    depth[here.tag] -= 1
                    here = here.parent
                depth[tag] -= 1
                yield "tag", here, tag
                here = here.parent
            continue
        while here.tag in _CLOSED_BY and tag in _CLOSED_BY[here.tag]:
            depth[here.tag] -= 1
            here = here.parent
        new = Element(tag, here, _keys(tag, attributes))
        yield "tag", new, tag
        if tag in FOREIGN and attributes.endswith("/"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID and not attributes.endswith("/"):
            here = new
            depth[tag] += 1


def _ancestors(e: Element | None) -> Iterator[Element]:
    while e is not None and e.tag:
        yield e
        e = e.parent


def _is_label(e: Element) -> bool:
    return e.tag in ("article", "main") or any(k.endswith("#itemprop=articleBody") for k in e.keys)


def _holders(e: Element) -> Iterator[Element]:
    """The elements that hold a text at ``e`` as one with what else they hold:
    the innermost that is no part of a running text, and those labelled."""
    here = e
    while here.tag in FLOW:
        here = here.parent
    yield here
    yield from (x for x in _ancestors(e) if x is not here and _is_label(x))


def counts(page: str) -> Counter | None:
    """``(key, inside)`` word counts of a labelled page, None if it is not.
    The article is the labelled element with the most words. A word inside
    counts for all its elements; one outside for its outermost element that
    has no article word, since that is what sets it apart."""
    words: Counter[Element] = Counter()
    for kind, e, text in parse(page):
        if kind == "text":
            words[e] += len(text.split())
    held: Counter[Element] = Counter()
    for e, n in words.items():
        for x in _ancestors(e):
            if _is_label(x):
                held[x] += n
    if not held:
        return None
    article = max(held, key=lambda x: held[x])
    inside = {e for e in words if any(x is article for x in _ancestors(e))}
    shared = {x for e in inside for x in _ancestors(e)}
    out: Counter = Counter()
    for e, n in words.items():
        if e in inside:
            for x in {k for x in _ancestors(e) for k in x.keys}:
                out[x, True] += n
        else:
            apart = [x for x in _ancestors(e) if x not in shared]
            for k in set(apart[-1].keys if apart else ()):
                out[k, False] += n
    return out


def fit(pages: DataFrame, sample_rows: int = 2000) -> dict[str, float]:
    """Log-odds weight of each element key, from at most ``sample_rows``
    different labelled pages (those with the smallest hashes of their html)."""
    labelled = (pages.select(F.col("html").cast("string").alias("html")).where("html is not null")
                .where(F.col("html").rlike(r"(?i)<(article|main)\b|articleBody"))
                .select("html", F.xxhash64("html").alias("h")))
    rows = labelled.select("h").distinct().orderBy("h").limit(sample_rows)
    limit = rows.agg(F.max("h")).first()[0]
    sample = labelled.where(F.col("h") <= (limit if limit is not None else 0)).dropDuplicates(["h"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in slices(batches):
            for page in batch.column(0):
                total.update(counts(page.as_py()) or {})
        if total:
            keys, inside = zip(*total, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(inside), pa.array(total.values(), pa.int64())],
                                             ["key", "inside", "n"])

    # names are free text, so keys that are rare in the sample are left to the priors
    found = (sample.select("html").mapInArrow(run, "key string, inside boolean, n long").groupBy("key")
             .agg(F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("a"),
                  F.sum(F.when(F.col("inside"), 0).otherwise(F.col("n"))).alias("b")).where("a + b >= 20").collect())
    return {r["key"]: math.log((r["a"] + 1) / (r["b"] + 1)) for r in found}


def _prior(key: str) -> float:
    tag, _, name = key.partition(".")
    return -3.0 if (name or tag) in (BOILERPLATE_NAMES if name else BOILERPLATE_TAGS) else 0.0


class Extractor:
    """``weights`` are an element's log-odds; ``tag_cost`` is what a tag costs
    that labelled articles do not hold, others cost a fiftieth of it and
    those of a formula nothing."""

    def __init__(self, weights: dict[str, float], tag_cost: float = 0.5):
        self.weights, self.tag_cost = weights, tag_cost

    def weight(self, e: Element) -> float:
        return min((self.weights.get(k, _prior(k)) for k in e.keys), default=0.0)

    def __call__(self, page: str | None) -> str:
        tokens: list[tuple[float, str | None]] = []
        held: dict[Element, list[int]] = {}  # first and last text of its holders
        skipped: list[tuple[int, Element]] = []
        known: dict[Element, float] = {}

        def score(e: Element) -> float:
            """The worst weight among the enclosing elements, -1 at least, +1 if none is negative."""
            if e not in known:
                chain = [x for x in _ancestors(e)]
                known[e] = min([1.0, *(max(w, -1.0) for x in chain if (w := self.weight(x)) < 0)])
            return known[e]

        for kind, e, text in parse(page or ""):
            s = score(e)
            if s < 0:
                skipped.append((len(tokens), e))
            if kind == "text":
                if s > 0 and not text.isspace():
                    for x in _holders(e):
                        held.setdefault(x, [len(tokens), 0])[1] = len(tokens)
                tokens.append((s * len(text.split()), text if s > 0 else None))
            else:
                own = self.weight(e)
                block = None if text in INLINE else " "
                cost = 0.0 if text in FORMULA else self.tag_cost / 50 if own > 0 else self.tag_cost
                tokens.append((min(max(own, -1.0), 0.0) - cost, block))
        for i, e in skipped:
            while e is not None and not (e in held and held[e][0] < i < held[e][1]):
                e = e.parent
            if e is not None:
                tokens[i] = 0.0, tokens[i][1]
        best = low = total = 0.0
        low_at = begin = end = 0
        for i, (s, _) in enumerate(tokens):
            total += s
            if total - low > best:
                best, begin, end = total - low, low_at, i + 1
            if total < low:
                low, low_at = total, i + 1
        return " ".join("".join(t for _, t in tokens[begin:end] if t).split())


def extract(pages: DataFrame, weights: dict[str, float]) -> DataFrame:
    """``row`` (struct of the columns of ``pages``, so names cannot clash) and
    ``text``, the main text of column html: empty for a null or empty page and
    for one without words outside boilerplate. Rows are independent: repeated
    ones give equal texts, an empty table none."""
    take = Extractor(weights)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [take(p.as_py()) for p in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["row", "text"])

    given = pages.select(F.struct(*[pages[c] for c in pages.columns]).alias("row"), pages["html"].cast("string").alias("html"))
    return given.mapInArrow(run, StructType([given.schema["row"], StructField("text", StringType())]))
