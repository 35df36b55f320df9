"""HTML extraction: a template per host from equivalence classes of tokens."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from wicketflow.llm.common import slices
from wicketflow.session import stage

#: A class of tokens is part of the template if it is on more than this share of a host's pages ...
SUPPORT = 0.5
#: ... and on so many different ones; with fewer, chance (or a near copy) would be a template.
MIN_PAGES = 4
#: The main element goes down to a child that holds this share of the slot text.
DOMINANT = 0.6

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt"
    " fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li"
    " main menu nav ol optgroup option p pre search section select summary table tbody td tfoot"
    " th thead tr ul".split())
#: Elements that can be the main one, and the root.
HOLDERS = frozenset(
    ["", *"html body div main section article center table tbody tr td form".split()])
#: Elements that are never main text; a header only outside of the article.
CHROME = frozenset(
    "head nav footer aside form script style noscript template iframe svg button select"
    " textarea option dialog menu object canvas math audio video search label input"
    " title".split())
#: Words of class, id and role that mark the same.
CHROME_WORDS = frozenset(
    "ad ads adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs"
    " comment comments complementary consent contentinfo cookie cookies disqus footer masthead"
    " menu modal nav navbar navigation newsletter notice notices popup promo promoted related"
    " replies reply respond share sharing sidebar social sponsor sponsored subscribe toolbar"
    " topbar widget".split())
HEADER_WORDS = frozenset({"header"})
#: An open element of the first kind ends where one of the second begins.
CLOSES = {"p": BLOCK - {"option", "optgroup"}, "li": frozenset({"li"}),
          "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}),
          "tr": frozenset({"tr", "tbody", "tfoot", "thead"}),
          "td": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
          "th": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
          "option": frozenset({"option", "optgroup"})}

TAG = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)"
                 r"((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)", re.S)
ATTRIBUTE = re.compile(r"(?i)\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")


@dataclass
class Element:
    tag: str
    path: str
    chrome: bool
    article: bool


@dataclass
class Page:
    """Tokens of a page: tag tokens with their path, and blocks of text with theirs."""

    tags: list[tuple[str, str]] = field(default_factory=list)
    blocks: list[tuple[str, str, bool, bool]] = field(default_factory=list)


def parse(html: str | None) -> Page:
    """Tags and blocks of a page. A tag token is told apart by its path of tags with classes;
    a text token by its path and text. A block is (text, path, chrome, in article)."""
    page, html = Page(), html or ""
    stack = [Element("", "", False, False)]
    held: list[str] = []
    at = 0

    def flush() -> None:
        text = " ".join(unescape("".join(held)).split())
        held.clear()
        if text:
            top = next(e for e in reversed(stack) if e.tag in BLOCK or not e.tag)
            page.blocks.append((text, top.path, stack[-1].chrome, stack[-1].article))

    def pop_to(depth: int) -> None:
        if any(e.tag in BLOCK or e.chrome for e in stack[depth:]):
            flush()
        del stack[depth:]

    while True:
        found = TAG.search(html, at)
        if found is None:
            held.append(html[at:])
            break
        held.append(html[at:found.start()])
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if depth:
                pop_to(depth)
            elif tag in BLOCK:
                flush()
            continue
        if tag == "br":
            held.append(" ")
            continue
        while len(stack) > 1:
            open_ = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag in BLOCK), 0)
            if open_ and tag in CLOSES.get(stack[open_].tag, ()):
                pop_to(open_)
            else:
                break
        top = stack[-1]
        words: set[str] = set()
        label = tag
        for name, *values in ATTRIBUTE.findall(found[3] or ""):
            value = "".join(values).lower()
            words.update(re.split(r"[^a-z0-9]+", value))
            if name.lower() == "class":
                label += "." + ".".join(sorted(value.replace("/", "|").split()))
        article = top.article or tag in ("article", "main") or "article" in words and tag == "div"
        chrome = (top.chrome or tag in CHROME or bool(words & CHROME_WORDS)
                  or not article and (tag == "header" or bool(words & HEADER_WORDS)))
        path = f"{top.path}/{label}"
        if tag in BLOCK or chrome != top.chrome:
            flush()
        page.tags.append((path, top.path))
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        if tag not in VOID and not (found[3] or "").rstrip().endswith("/"):
            stack.append(Element(tag, path, chrome, article))
    flush()
    return page


def token(*parts: str) -> int:
    """A token's name as a signed 64-bit number."""
    value = xxh64_intdigest("\x1f".join(parts))
    return value - (1 << 64) if value >> 63 else value


def host_of(url: Column) -> Column:
    """The lower-case host of a URL; empty if there is none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][\w+.-]*://([^/?#]*)", 1)
    return F.lower(F.regexp_replace(found, r"^.*@|:\d*$", ""))


TOKENS = ("host string, token long, page long, n long, kind string, path string, parent string,"
          " chars long")


def tokens(pages: DataFrame) -> DataFrame:
    """How often each token comes in each page: a page's part of the occurrence vectors."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                rows = []
                for host, html in zip(part.column("host").to_pylist(),
                                      part.column("html").to_pylist(), strict=True):
                    page, seen = parse(html), {}
                    own = token(html or "")
                    for path, parent in page.tags:
                        key = (token("tag", path), "tag", path, parent, 0)
                        seen[key] = seen.get(key, 0) + 1
                    for text, path, chrome, _ in page.blocks:
                        if not chrome:
                            key = (token("text", path, text), "text", path, path, len(text))
                            seen[key] = seen.get(key, 0) + 1
                    rows += [(host, k[0], own, n, *k[1:]) for k, n in seen.items()]
                columns = list(zip(*rows, strict=True)) or [()] * 8
                kinds = [pa.string()] + [pa.int64()] * 3 + [pa.string()] * 3 + [pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names=[x.split()[0] for x in TOKENS.split(", ")])

    return pages.select("host", "html").mapInArrow(run, TOKENS)


def vectors(pages: DataFrame) -> DataFrame:
    """(host, token, kind, path, parent, chars, pages, total, class_id) of all tokens.

    Tokens with equal occurrence vectors over the host's different pages are of one class. A
    vector is stood for by two sums of hashes of (page, count), which combine before the
    shuffle, so a host's size does not matter. `chars` is summed over the pages, `total` is
    the host's number of different pages.
    """
    once = tokens(pages).groupBy("host", "token", "page").agg(
        F.max("n").alias("n"), F.max("chars").alias("chars"),
        *[F.first(c).alias(c) for c in ("kind", "path", "parent")])
    sums = [F.sum(F.xxhash64("page", "n", F.lit(i)).bitwiseAND(F.lit((1 << 40) - 1)))
            .alias(f"v{i}") for i in (1, 2)]
    held = stage(once.groupBy("host", "token").agg(
        F.count("*").alias("pages"), *sums, F.sum(F.col("n") * F.col("chars")).alias("chars"),
        *[F.first(c).alias(c) for c in ("kind", "path", "parent")]), "tokens")
    total = stage(pages.select("host", F.xxhash64("html").alias("h")).distinct()
                  .groupBy("host").agg(F.count("*").alias("total")), "hosts")
    return held.join(total, "host").withColumn("class_id", F.xxhash64("pages", "v1", "v2"))


def classes(told: DataFrame, support: float = SUPPORT, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, token, kind, path, class_id, parent_class): the template of each host.

    A class is valid if it is on `min_pages` different pages of the host at least and on more
    than `support` of them, and if it nests: a text belongs to the template if the element it
    stands in, or one around that, is of its own class, so that text and element come and go
    together; a tag nests in the class of the element around it. A host has a bounded number
    of such tokens: the mean number in a page, divided by `support`.
    """
    valid = told.where((F.col("pages") >= min_pages) & (F.col("pages") > support * F.col("total")))
    tags = valid.where("kind = 'tag'").select(
        "host", F.col("path").alias("around"), F.col("class_id").alias("parent_class"))
    above = F.explode(F.transform(
        F.sequence(F.lit(1), F.size(F.split("parent", "/"))),
        lambda i: F.array_join(F.slice(F.split("parent", "/"), 1, i), "/"))).alias("around")
    texts = (valid.where("kind = 'text'").select("host", "token", "kind", "path", "class_id", above)
             .join(tags, ["host", "around"]).where("class_id = parent_class")
             .groupBy("host", "token").agg(*[F.first(c).alias(c) for c in (
                 "kind", "path", "class_id", "parent_class")]))
    nested = (valid.where("kind = 'tag'").withColumnRenamed("parent", "around")
              .join(tags, ["host", "around"], "left")
              .select("host", "token", "kind", "path", "class_id", "parent_class"))
    return nested.union(texts)


def templates(pages: DataFrame, dominant: float = DOMINANT) -> DataFrame:
    """(host, main, fixed): where a host's main slots are, and the texts its template fixes.

    The characters of slots (text outside the template and outside chrome) are summed for
    each template element of a host. From the root, the main element is the deepest that still
    holds `dominant` of them, or the article around it. It is an element that holds blocks,
    never one of the blocks: paragraphs of equal path would leave out the headings and lists
    beside them. Hosts without a valid class have no row. All of this is counted from the
    tokens; pages are read once.
    """
    told = vectors(pages)
    template = stage(classes(told), "template")
    fixed = (template.where("kind = 'text'").groupBy("host")
             .agg(F.collect_set("token").alias("fixed")))
    elements = template.where("kind = 'tag'").select("host", "path").union(
        template.select("host", F.lit(""))).distinct()
    slots = told.where("kind = 'text'").join(
        template.where("kind = 'text'").select("host", "token"), ["host", "token"], "left_anti")
    steps = F.split("path", "/")
    holders = F.filter(
        F.transform(F.sequence(F.lit(1), F.size(steps)),
                    lambda i: F.slice(steps, 1, i)),
        lambda p: F.forall(p, lambda x: F.substring_index(x, ".", 1).isin(*sorted(HOLDERS))))
    sums = (slots.select("host", "chars", F.explode(holders).alias("p"))
            .select("host", "chars", F.array_join("p", "/").alias("path"))
            .groupBy("host", "path").agg(F.sum("chars").alias("chars")))
    whole = sums.where("path = ''").select("host", F.col("chars").alias("whole"))
    deepest = (sums.join(elements, ["host", "path"]).join(whole, "host")
               .where(F.col("chars") >= dominant * F.col("whole"))
               .groupBy("host").agg(F.max_by("path", F.length("path")).alias("main")))
    article = F.regexp_extract("main", r"^(?:.*?/)?(?:article|main)(?:\.[^/]*)?(?=/|$)", 0)
    main = deepest.withColumn("main", F.when(article != "", article).otherwise(F.col("main")))
    return main.join(fixed, "host", "left")


def page_text(html: str | None, main: str | None, fixed: set[int]) -> str:
    """The slots of the main text, one block a line.

    `main` is the element that holds the host's main slots, None without a template. Texts
    that the template fixes are left out wherever they stand. What varies from page to page and
    is no main text (reader comments, forms) is known by its marks alone. A page without
    a template, or with no slot in the main element, is read by its structure: its article if
    it has one.
    """
    blocks = [b for b in parse(html).blocks
              if not b[2] and (not fixed or token("text", b[1], b[0]) not in fixed)]
    if main is not None:
        inside = [b for b in blocks if b[1] == main or b[1].startswith(main + "/")]
        if inside:
            return "\n".join(b[0] for b in inside)
    article = [b for b in blocks if b[3]]
    return "\n".join(b[0] for b in article or blocks)


def extract(df: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """`df` with `text`, the main text of each page; empty for a null or empty page.

    Tokens of same-host pages that share an occurrence vector form classes, valid classes
    nest into the host's template, and what the template does not fix are slots, of which
    those of the main element are kept. Pages without a host count as one host; a host with
    fewer than MIN_PAGES different pages has no template, and its structure alone decides.
    Copies of a page count once in the template and each get their text. Other columns pass
    through; a column called `text` is replaced. Pages do not move while the templates, which
    are written first, are small enough to be broadcast by Spark's own limit; beyond that they
    are shuffled by host, and a hot host's rows are split by adaptive execution.
    """
    df = df.drop("text")
    taken = {"__host", "__main", "__fixed"} & set(df.columns)
    if taken:
        raise ValueError(f"columns of these names cannot pass: {sorted(taken)}")
    pages = df.select(host_of(F.col(url)).alias("host"), F.col(html).alias("html"))
    found = stage(templates(pages), "templates").select(
        F.col("host").alias("__host"), F.col("main").alias("__main"),
        F.col("fixed").alias("__fixed"))
    joined = df.join(found, host_of(df[url]) == F.col("__host"), "left").drop("__host")
    keep = df.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, html):
                texts = [page_text(h, m, set(f or ())) for h, m, f in zip(
                    *(part.column(c).to_pylist() for c in (html, "__main", "__fixed")),
                    strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.array(texts, pa.string())],
                    names=[*keep, "text"])

    return joined.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("text", T.StringType())]))
