"""Main text of web pages by site style trees.

The pages of a host are merged into one tree of styles: a node is a path of elements, each known
by its tag, classes and role. A node's importance is the entropy of what it shows across the
host's distinct pages: of the sequences of its children's styles (presentation), and for a leaf of
its text (content). A composite importance folds in the branches below. Branches that show the
same on page after page have a low one and are cut from each page. Elements whose kind declares
them no content (menus, footers, adverts, forms, comments and so on) have importance 0, an element that declares itself
the article has 1, whose branches are judged like all others. Where a page has one, a branch outside it that is too rare
to be judged does not count.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import chunks, rows, small_batches, stored

LEAST_IMPORTANCE = 0.3  # branches below are cut
LEAST_PAGES = 4  # distinct pages that a branch needs before it is judged
BROADCAST_NODES = 1_000_000  # judged nodes that every task looks up; beyond, they are joined to the pages
CUT, HIGH = -1, 1  # verdicts on a node
DECAY = 0.9  # how far more variants of a node let its own entropy outweigh its branches

#: Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark nobr q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var wbr".split()
)
HIDDEN = frozenset(
    "head title script style noscript template iframe object svg math canvas audio video form button select textarea"
    " fieldset option datalist input label dialog nav footer aside menu".split()
)
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "noembed", "noframes", "xmp", "template")
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4"
    " h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
SIBLINGS = {k: frozenset(v.split()) for k, v in {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}.items()}
#: Words in class, id or role that name what is not the article.
NO_CONTENT = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside footer complementary contentinfo banner masthead"
    " ad ads adv advert adverts advertisement adsense sponsor sponsored promo promotion cookie cookies consent gdpr notice"
    " notices notification alert popup modal overlay newsletter subscribe subscription signup login search social share sharing"
    " related recommended recommendations comment comments commentlist disqus respond reply replies widget toolbar pagination"
    " pager copyright legal hidden skip".split()
)
ARTICLE_WORDS = frozenset(("main", "article"))

#: Words that structure a name and say nothing by themselves.
PLAIN_WORDS = frozenset("area bar block box container inner item items left link links list outer right section site top bottom wrap wrapper".split())
#: Names that say an element holds the article's text, whatever else it is called.
CONTENT_NAMES = frozenset("content article main entry story post text".split())
#: Elements that hold others, and whose names may tell that all they hold is no content.
CONTAINERS = frozenset("div section ul ol dl table tbody details figure center span hgroup address".split())
#: Words that tell so of any element, inline ones too.
NEVER = frozenset("ad ads advert adverts advertisement adsense sponsor sponsored share sharing hidden".split())


def token_pattern(attrs: str) -> re.Pattern:
    return re.compile(
        r"<!--.*?(?:-->|\Z)"
        r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])(?P<rawattrs>" + attrs + r")>(?P<inside>.*?)(?:</(?P=raw)\s*>|\Z)"
        r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>" + attrs + r")>"
        r"|<[!?/][^>]*>",
        re.S | re.I,
    )


TOKEN = token_pattern(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+")
LOOSE = token_pattern(r"[^>]*+")  # where a quote is left open, a tag ends at the next bracket
TAG_CUT_OFF = re.compile(r"<[a-zA-Z/!][^>]*+\Z")  # by the end of the page
NAMED = re.compile(r"(?:^|\s)(class|id|role|hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")


@dataclass
class Element:
    """An element of a page that holds blocks; style names it among its siblings."""

    tag: str
    style: str
    node: int  # hash of the path of styles
    parent: int  # place of the parent in the page's list, -1 for the root
    out: bool  # no content, or within such
    core: bool  # declares itself the article, or within such
    depth: int = 0
    declared: bool = False  # declares itself the article
    children: list = field(default_factory=list)
    text: list = field(default_factory=list)


def tokens(source: str) -> Iterator[re.Match]:
    """The tags and comments of a page, in linear time: a quote that is left open is looked for once, after which quotes don't count."""
    last, at, pattern = source.rfind(">"), 0, TOKEN
    while (at := source.find("<", at)) >= 0:
        if at > last and not source.startswith("<!--", at):
            return  # nothing that starts here ends
        found = pattern.match(source, at)
        if found is None and pattern is TOKEN and (source[at + 1 : at + 2].isalpha() or source.startswith("</", at)):
            pattern = LOOSE
            found = pattern.match(source, at)
        if found is None:
            at += 1
            continue
        yield found
        at = found.end()


@dataclass
class Names:
    """What the attributes of an element call it: words of each name in class and role, words of its id, and whether it is hidden."""

    names: list[list[str]] = field(default_factory=list)
    own: list[str] = field(default_factory=list)
    hidden: bool = False

    @property
    def words(self) -> set[str]:
        return {w for name in (*self.names, self.own) for w in name}

    def never_content(self) -> bool:
        return self.hidden or any(w in NEVER for name in self.names for w in name)

    def no_content(self, tag: str, core: bool) -> bool:
        """Whether the names tell that nothing within is content.

        Of a container one word of one name is enough, unless another name says that it holds the text, and an id counts if all
        its words do. Of a heading, a paragraph and the like a whole name has to say so, and within a declared article none does.
        """
        if self.never_content():
            return True
        told = lambda name: bool(name) and not NO_CONTENT.isdisjoint(name) and (NO_CONTENT | PLAIN_WORDS).issuperset(name)
        if tag in CONTAINERS:
            if any(len(name) == 1 and name[0] in CONTENT_NAMES for name in self.names):
                return False
            return any(not NO_CONTENT.isdisjoint(name) for name in self.names) or told(self.own)
        return not core and any(told(name) for name in self.names)


def style_of(tag: str, attrs: str) -> tuple[str, Names]:
    """The style's name, and what the attributes call the element."""
    found, named = Names(), []
    for name, value in NAMED.findall(attrs) if attrs.strip() else ():
        value, name = value.strip("\"'"), name.lower()
        if name == "hidden":
            found.hidden = True
            continue
        split = [[w.lower() for w in SPLIT.split(v) if w] for v in value.split()]
        if name == "id":
            found.own += [w for part in split for w in part]
        else:
            found.names += split
            named += sorted(value.lower().split())
    return ".".join([tag, *named]), found


def parse(source: str, site: int = 0) -> tuple[list[Element], list[tuple[int, str]]]:
    """The elements of a page and its text blocks in order, each with its element's place. ``site`` tells hosts' nodes apart."""
    root = Element("", "", site, -1, False, False)
    elements, blocks, open_, buffer = [root], [], [0], []
    held = Counter()  # open elements of each tag
    muted, level, nested = "", 0, 0  # an inline element that is no content, where it stands, and how many of its tag are open

    def flush() -> None:
        if buffer:
            text = " ".join("".join(buffer).split())
            buffer.clear()
            if text:
                blocks.append((open_[-1], text))
                elements[open_[-1]].text.append(text)

    def close(i: int) -> None:
        nonlocal muted
        flush()
        held.subtract(elements[x].tag for x in open_[i:])
        del open_[i:]
        if len(open_) < level:
            muted = ""

    last = 0
    for m in tokens(source):
        if m.start() > last and not muted:
            buffer.append(decoded(source[last : m.start()]))
        last = m.end()
        if m["raw"] is not None or m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if tag in INLINE:
            if tag == muted:
                nested += -1 if m["end"] else 1
                muted = muted if nested else ""
            elif not muted and not m["end"] and tag not in VOID and m["attrs"].strip() and style_of(tag, m["attrs"])[1].never_content():
                muted, level, nested = tag, len(open_), 1
            continue
        if tag == "br":
            buffer.append(" ")
            continue
        if m["end"]:
            if held[tag] > 0:
                close(next(i for i in range(len(open_) - 1, 0, -1) if elements[open_[i]].tag == tag))
            else:
                flush()
            continue
        flush()
        if tag in CLOSES_P and elements[open_[-1]].tag == "p":
            close(len(open_) - 1)
        if tag in SIBLINGS and elements[open_[-1]].tag in SIBLINGS[tag]:
            close(len(open_) - 1)
        if tag in VOID:
            continue
        style, names = style_of(tag, m["attrs"])
        at = open_[-1]
        above, page = elements[at], tag in ("html", "body")
        declared = tag in ("article", "main") or bool(tag in ("div", "section") and names.words & ARTICLE_WORDS)
        core = above.core or declared
        out = above.out or bool(muted) or tag in HIDDEN or (not page and names.no_content(tag, core))
        out = out or (not core and (tag == "header" or ("header" in names.words and not page)))
        node = xxhash.xxh64_intdigest(f"{above.node}/{style}") >> 1
        above.children.append(style)
        elements.append(Element(tag, style, node, at, out, core, above.depth + 1, declared))
        if not m["attrs"].endswith("/") or tag not in ("path", "rect", "use"):
            open_.append(len(elements) - 1)
            held[tag] += 1
    if last < len(source) and not muted:
        rest = source[last:]
        cut = TAG_CUT_OFF.search(rest)
        buffer.append(decoded(rest[: cut.start()] if cut else rest))
    flush()
    return elements, blocks


def decoded(text: str) -> str:
    return entities.unescape(text) if "&" in text else text


def main_text(source: str, verdicts: Callable[[np.ndarray], np.ndarray] | None = None, site: int = 0) -> str:
    """The page's text without what is no content. ``verdicts`` gives for nodes CUT, HIGH, or 0 where there is none.

    Where the page declares an article, what stands outside it needs HIGH.
    """
    elements, blocks = parse(source, site)
    found = [0] * len(elements) if verdicts is None else verdicts(np.array([e.node for e in elements], np.int64)).tolist()
    cut = [False] * len(elements)
    for i, e in enumerate(elements):
        cut[i] = found[i] == CUT or (e.parent >= 0 and cut[e.parent])
    declared = any(elements[i].core and not elements[i].out for i, _ in blocks)
    return " ".join(t for i, t in blocks if not (elements[i].out or cut[i]) and (not declared or elements[i].core or found[i] == HIGH))


def shown(source: str, site: int = 0) -> list[tuple[int, int, int, int]]:
    """(node, parent node, hash of what it shows, mark) of each element of a page that may be content.

    A run of equal children counts as one, so that longer and shorter articles look alike. A mark is the node's depth * 8,
    + 4 at one of a page's rows for the node, + 2 within a declared article, + 1 if it declares one.
    """
    elements, _ = parse(source, site)
    found = {}
    for e in elements[1:]:
        if e.out:
            continue
        if not e.children:
            value = "\n".join(e.text)
        else:
            value = "/" + "/".join(c for i, c in enumerate(e.children) if not i or c != e.children[i - 1])
        key = (e.node, elements[e.parent].node, xxhash.xxh64_intdigest(value) >> 1)
        found[key] = found.get(key, 0) | 2 * e.core | e.declared | 8 * e.depth
    made, last = [], None
    for key, mark in sorted(found.items()):
        made.append((*key, mark + 4 * (key[0] != last)))
        last = key[0]
    return made


def host_of(url: Column) -> Column:
    """The host of an address, in lower case; '' where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)", 1), F.lit("")))


def shown_by_pages(pages: DataFrame) -> DataFrame:
    """(page, node, parent, value, mark): what the distinct pages of rows (site, page, html) show."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, "html"):
            which, found = [], []
            for i, (source, site) in enumerate(zip(texts, part.column("site").to_pylist())):
                of = shown(source, site)
                which += [i] * len(of)
                found += of
            columns = np.array(found, np.int64).reshape(-1, 4).T
            page = part.column("page").take(pa.array(which, pa.int64()))
            yield rows(page=page, **dict(zip(("node", "parent", "value", "mark"), map(np.ascontiguousarray, columns))))

    found = pages.select("site", "page", "html").mapInArrow(run, "page long, node long, parent long, value long, mark long")
    return found.distinct()


def node_facts(found: DataFrame) -> DataFrame:
    """Of each node: parent, depth, core, declared, judged, weight (what it shows, on all pages), variants and own importance.

    What pages show is counted by node and variant, then by node; both steps fold before they shuffle, so a host of any size is
    no hot group.
    """
    bit = lambda k: F.col("mark").bitwiseAND(F.lit(k)) > 0
    variant = found.groupBy("node", "parent", "value").agg(
        F.count("*").alias("n"),
        F.sum(bit(4).cast("long")).alias("pages"),
        F.max(F.shiftright("mark", 3)).alias("depth"),
        F.max(bit(2)).alias("core"),
        F.max(bit(1)).alias("declared"),
    )
    entropy = F.log(F.sum("n")) - F.sum(F.col("n") * F.log("n")) / F.sum("n")
    return variant.groupBy("node").agg(
        F.first("parent").alias("parent"),
        *(F.max(c).alias(c) for c in ("depth", "core", "declared")),
        (F.sum("pages") >= LEAST_PAGES).alias("judged"),
        F.sum("n").alias("weight"),
        F.count("*").alias("variants"),
        F.when(F.sum("n") > 1, entropy / F.log(F.sum("n"))).otherwise(0.0).alias("own"),
    )


def importance(nodes: DataFrame, least: float) -> DataFrame:
    """(node, value, safe, core) of each judged node: its composite importance, and whether it or a branch has ``least``.

    (1 - DECAY^variants) of its own and the rest from the mean of its judged branches, by weight. A branch too rare to be
    judged may be content: a node that has one counts as important by itself. Each level is folded from the one below, from the
    deepest that enough pages of a host share: what stands above a judged node is judged as well.
    """
    spark, levels, below = nodes.sparkSession, [], None
    own = ("node", "parent", "core", "declared", "judged", "weight", "variants", "own")
    nothing = {"m": F.lit(None).cast("long"), "mv": F.lit(None).cast("double"), "rare": F.col("some_rare"), "high": F.lit(False)}
    rare = nodes.where(~F.col("judged")).groupBy("parent").agg(F.lit(True).alias("some_rare")).withColumnRenamed("parent", "above")
    nodes = nodes.where("judged").join(rare, F.col("node") == F.col("above"), "left").withColumn("some_rare", F.coalesce("some_rare", F.lit(False)))
    nodes = stored(nodes.drop("above"), "judged-nodes")
    for depth in range(nodes.agg(F.max("depth")).first()[0] or 0, 0, -1):
        level = nodes.where(F.col("depth") == depth).select("node", F.struct(*own[1:]).alias("facts"), *(c.alias(k) for k, c in nothing.items()))
        if below is not None:
            m = F.when(F.col("judged"), F.col("weight"))
            level = level.unionAll(
                below.select(
                    F.col("parent").alias("node"),
                    F.lit(None).cast(level.schema["facts"].dataType).alias("facts"),
                    m.alias("m"),
                    (m * F.col("value")).alias("mv"),
                    (~F.col("judged")).alias("rare"),
                    (F.col("judged") & F.col("safe")).alias("high"),
                )
            )
        level = level.groupBy("node").agg(
            F.max("facts").alias("facts"), F.sum("m").alias("m"), F.sum("mv").alias("mv"), F.max("rare").alias("rare"), F.max("high").alias("high")
        )
        level = level.select("node", "facts.*", "m", "mv", "rare", "high")
        alone, keep = F.when(F.col("rare"), 1.0).otherwise(F.col("own")), F.pow(F.lit(DECAY), F.col("variants"))
        mixed = F.when(F.col("m") > 0, (1 - keep) * alone + keep * F.col("mv") / F.col("m")).otherwise(alone)
        level = level.withColumn("value", F.when(F.col("declared"), 1.0).otherwise(mixed))
        level = level.withColumn("safe", F.col("high") | (F.col("value") >= least))
        below = stored(level.select("node", "parent", "core", "judged", "weight", "value", "safe"), "level")
        levels.append(below.where("judged").select("node", "value", "safe", "core"))
    made = spark.createDataFrame([], "node long, value double, safe boolean, core boolean")
    for level in levels:
        made = made.unionAll(level)
    return made


def verdicts_by_node(found: DataFrame, least: float = LEAST_IMPORTANCE) -> DataFrame:
    """(node, verdict): CUT for nodes that with all their branches are less important than ``least``, HIGH for others that
    are as important and stand outside declared articles. Every node on LEAST_PAGES of its host's distinct pages is judged."""
    nodes = stored(node_facts(found), "nodes")
    verdict = F.when(~F.col("safe"), CUT).when((F.col("value") >= least) & ~F.col("core"), HIGH)
    return importance(nodes, least).select("node", verdict.alias("verdict")).where("verdict is not null")


def extract(pages: DataFrame, least: float = LEAST_IMPORTANCE) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    A null or empty html gives an empty text; a null url belongs to the host ''. Repeated rows give equal
    rows, null ids stay null, other columns play no part. Hosts, pages and nodes are told apart by 64-bit hashes.
    """
    small_batches(pages.sparkSession)
    host = host_of(F.col("url"))
    own = pages.select("page_id", "url", "html", F.xxhash64(host).alias("site"), F.xxhash64(host, "html").alias("page"))
    found = stored(shown_by_pages(own), "shown")
    judged = stored(verdicts_by_node(found, least), "verdicts")
    table = None
    if judged.count() <= BROADCAST_NODES:
        table = judged.toArrow().sort_by("node")
        table = pages.sparkSession.sparkContext.broadcast(tuple(table.column(c).to_numpy() for c in ("node", "verdict")))
        joined = own.withColumn("judged", F.lit(None).cast("array<struct<node:long,verdict:int>>"))
    else:
        of = found.select("page", "node").distinct().join(judged, "node").groupBy("page")
        of = stored(of.agg(F.collect_list(F.struct("node", "verdict")).alias("judged")), "judged")  # its size decides the join
        joined = own.join(of, "page", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def every(nodes: np.ndarray) -> np.ndarray:
            known, verdict = table.value
            if not len(known):
                return np.zeros(len(nodes), np.int32)
            at = np.minimum(np.searchsorted(known, nodes), len(known) - 1)
            return np.where(known[at] == nodes, verdict[at], 0)

        def listed(judged: list[dict] | None) -> Callable[[np.ndarray], np.ndarray]:
            known = {x["node"]: x["verdict"] for x in judged or ()}
            return lambda nodes: np.array([known.get(n, 0) for n in nodes.tolist()], np.int32)

        for part, sources in chunks(batches, "html"):
            sites, lists = part.column("site").to_pylist(), part.column("judged").to_pylist()
            text = [main_text(s, every if table else listed(x), site) for s, x, site in zip(sources, lists, sites)]
            yield rows(
                page_id=part.column("page_id"),
                url=part.column("url"),
                text=pa.array(text, pa.string()),
                n_chars=np.array([len(t) for t in text], np.int64),
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    joined = joined.select("page_id", "url", "html", "site", "judged")
    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
