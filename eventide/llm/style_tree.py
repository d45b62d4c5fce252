"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree. An element node is a tag with its
identifying attributes under its parent's path; each page adds what the node
shows there: its child elements in order and its own text, to which elements
within a line belong. Over the pages of the host that have the node, the normalised
entropy of what they show is its importance: 0 when every page shows the same, 1
when each shows another. The own text of a node of low importance is removed from
each page; a branch goes when all of its nodes do, and nothing important goes with
the branch above it.

Elements that repeat under one parent (the paragraphs of an article) share a path, so
they are aligned by what they show: a block shown on c of the m pages that have the
path is a node of its own, beside which each other page shows something else. Its
importance is 1 - c ln c / (m ln m), so a notice among the paragraphs goes when
nearly every page has it, wherever it stands.

Entropy says nothing about a host with one page, and little about chrome
whose text turns with every page. Tags and attribute words that name chrome
(``nav``, ``footer``, ``class="ad"``, ...) therefore start as presentation of
no importance, as does, on a page that has tags that hold an article (``article``,
``main``), all that is outside these; the entropies decide all other branches,
those inside an article too.
"""

from __future__ import annotations

import html as entities
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm.common import map_arrow, stored, table
from eventide.llm.url_rules import url_host

LOW, DECAY, LEAST_PAGES = 0.2, 0.9, 3
#: Hosts with more than one of so many shares of all pages are dealt over several parts.
HOT_SHARE = 1000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
#: Never article text.
SILENT = frozenset("head script style title noscript template iframe object embed svg math canvas audio video map form "
                   "button select option textarea input label fieldset datalist nav header footer aside menu dialog".split())
HOLDERS = frozenset("article main".split())
#: Elements that flow within a line; all others end a block.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span "
                   "strike strong sub sup time tt u var wbr img".split())
#: Words of class, id and role values that name chrome.
CHROME = frozenset("ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo banner nav navbar "
                   "navigation menu menubar breadcrumb breadcrumbs header masthead footer sidebar aside widget cookie cookies "
                   "consent notice notices alert popup modal comment comments respond reply replies disqus share sharing social "
                   "related recommended newsletter subscribe subscription signup login search form toolbar pagination pager "
                   "copyright legal complementary contentinfo".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
                     "h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: A start tag on the left ends an open element on the right, up to the nearest holder.
ENDS = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
        "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
        "option": ("option", ("select",)), "tbody": ("thead tbody tr td th", ("table",)),
        "tfoot": ("thead tbody tr td th", ("table",)), "thead": ("thead tbody tr td th", ("table",))}

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                   r"<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s\"'=<>`]+)))?")
SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
SPACES = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "mark", "parent", "parts", "chrome", "holder")

    def __init__(self, tag: str, mark: str, parent, chrome: bool, holder: bool):
        self.tag, self.mark, self.parent, self.parts = tag, mark, parent, []
        self.chrome, self.holder = chrome, holder


def parse(page: str) -> Node:
    """A tolerant tree of a page: ``parts`` of a node are texts and nodes in
    page order. Unclosed tags end where the next tag or their parent ends
    them; stray end tags are skipped; comments vanish."""
    root = Node("", "", None, False, False)
    node, at, end = root, 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        if m is None:
            node.parts.append(page[at:])
            break
        if m.start() > at:
            node.parts.append(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                node.parts.append(entities.escape(m[0][9:].removesuffix("]]>"), False))
            continue
        tag = m[2].lower()
        if m[1]:
            up = node
            while up is not root and up.tag != tag:
                up = up.parent
            if up is not root:
                node = up.parent
            elif tag == "p":
                node.parts.append(Node("p", "p", node, False, False))
            continue
        if tag in CLOSES_P:
            up = node
            while up is not root and up.tag in INLINE:
                up = up.parent
            if up.tag == "p":
                node = up.parent
        if tag in ENDS:
            ended, stop = ENDS[tag]
            ended, up, last = ended.split(), node, None
            while up is not root and up.tag not in stop:
                if up.tag in ended:
                    last = up
                up = up.parent
            if last is not None:
                node = last.parent
        words = {k.lower(): entities.unescape(a or b or c or "") for k, a, b, c in ATTRIBUTE.findall(m[3])} if m[3].strip(" /") else {}
        names = " ".join(words[k] for k in ("class", "id", "role") if k in words)
        chrome = tag in SILENT or (bool(names) and not CHROME.isdisjoint(SPLIT.split(names.lower()))) or "hidden" in words
        child = Node(tag, f"{tag}.{words['class'].strip()}" if words.get("class") else tag, node, chrome and tag not in ("html", "body"),
                     tag in HOLDERS or words.get("role") == "main")
        node.parts.append(child)
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = close.end() if close else end
        elif tag not in VOID and not m[3].rstrip().endswith("/") or tag in ("p", "div") and m[3].rstrip().endswith("/"):
            node = child
    return root


def nodes(root: Node):
    """Every element below the root with its path key, parents first; a node's
    path is its marks from the top, so equal branches of pages meet."""
    todo = [(p, "") for p in reversed(root.parts) if not isinstance(p, str)]
    while todo:
        node, above = todo.pop()
        path = f"{above}/{node.mark}"
        yield node, path
        todo += [(p, path) for p in reversed(node.parts) if not isinstance(p, str)]


def key(path: str) -> int:
    return zlib.crc32(path.encode("utf-8", "surrogatepass")) | zlib.adler32(path.encode("utf-8", "surrogatepass")) << 31 & (1 << 62) - 1


def flow(root: Node):
    """What a page shows outside chrome, in page order, as ``(owner, held, item)``:
    ``owner`` is the block that holds the item, its path and a number of its own, as
    elements within a line belong to their block's text; ``held`` tells that it lies in a
    holder; ``item`` is a text, an element that starts, or None where a block ends."""
    top, count = ("", 0), 0
    todo = [(p, "", top, False) for p in reversed(root.parts)]
    yield top, False, ""
    while todo:
        item, above, owner, held = todo.pop()
        yield owner, held, item
        if item is None or isinstance(item, str):
            continue
        path, inline = f"{above}/{item.mark}", item.tag in INLINE
        if not inline:
            todo.append((None, above, owner, held))
        if not item.chrome:
            held = held or item.holder
            if not inline or item.holder:
                count += 1
                owner = (path, count)
                yield owner, held, ""
            todo += [(p, path, owner, held) for p in reversed(item.parts)]


def faces(items) -> dict[tuple[str, int], str]:
    """What each block of a page's ``flow`` shows: its child elements and own text in order."""
    shown: dict[tuple[str, int], list] = {}
    for owner, _held, item in items:
        face = shown.setdefault(owner, [])
        if isinstance(item, str):
            text = SPACES.sub(" ", item).strip()
            if text:
                face.append("\x01" + text)
        elif item is not None:
            face.append("\x00" + item.mark)
    return {owner: "".join(face) for owner, face in shown.items()}


def block_key(node: int, seen: int) -> int:
    """The key of a path's blocks that show ``seen``; negative, unlike a path's key."""
    return -(node ^ seen >> 1) - 1


def has_holder(root: Node) -> bool:
    return any(n.holder and not n.chrome for n, _ in nodes(root))


def text_of(root: Node, low: frozenset | set) -> str:
    """Texts of the blocks that stay, white space within a block made one
    space, blocks joined by one space. A block in ``low`` loses its own text
    only: blocks below it stay or go by themselves."""
    blocks, line, items = [], [], list(flow(root))
    gone = set()
    if low:
        for owner, face in faces(items).items():
            node = key(owner[0])
            if node in low or block_key(node, key(face)) in low:
                gone.add(owner)

    def close():
        if line:
            text = SPACES.sub(" ", "".join(line)).strip()
            if text:
                blocks.append(text)
            line.clear()

    everywhere = not has_holder(root)
    for owner, held, item in items:
        if isinstance(item, str):
            if item and (held or everywhere) and owner not in gone:
                line.append(entities.unescape(item))
        elif item is None or item.tag not in INLINE:
            close()
    close()
    return " ".join(blocks)


def branch_counts(pages: DataFrame) -> DataFrame:
    """``(host, node, one, held, seen, page)`` for every block a page shows: ``node`` is
    the hash of its path, ``held`` 1 inside a holder, ``seen`` the hash of its child
    elements and its own text. Chrome, whose importance is fixed, is not looked
    into. A page counts once per path (``one`` 0), where repeated elements add to one hash; a
    path with several blocks that show anything also has a row for each of them that shows text (``one`` 1).
    Pages of a host that show the same text count as one, so copies don't pass for chrome."""
    def run(batches):
        for batch in batches:
            host, node, one, inside, seen, whole = [], [], [], [], [], []
            for h, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                root = parse(page)
                items = list(flow(root))
                held_at: dict[str, bool] = {}
                for owner, held, _item in items:
                    held_at[owner[0]] = held_at.get(owner[0], False) or held
                by_path: dict[str, list] = {path: [] for path in held_at}
                for owner, face in faces(items).items():
                    if face:
                        by_path[owner[0]].append(face)
                everywhere = not has_holder(root)
                same = key("\x02".join(f"{path}\x03{''.join(f)}" for path, f in by_path.items() if everywhere or held_at[path]))
                for path, f in by_path.items():
                    rows = [(0, key("".join(f)))]
                    if len(f) > 1:
                        rows += [(1, key(x)) for x in dict.fromkeys(f) if "\x01" in x]
                    host += [h] * len(rows)
                    node += [key(path)] * len(rows)
                    one += [r[0] for r in rows]
                    inside += [int(held_at[path])] * len(rows)
                    seen += [r[1] for r in rows]
                    whole += [same] * len(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(host, pa.string()), pa.array(node, pa.int64()), pa.array(one, pa.int64()), pa.array(inside, pa.int64()),
                 pa.array(seen, pa.int64()), pa.array(whole, pa.int64())], names=["host", "node", "one", "held", "seen", "page"])
    rows = map_arrow(pages.select("host", "html"), run, "host string, node long, one long, held long, seen long, page long")
    return rows.distinct()


def low_branches(counts: DataFrame, low: float, decay: float, least_pages: int) -> DataFrame:
    """``(host, node)`` of blocks whose own importance is below ``low``: of all blocks of a path, under
    its hash, and of those of its blocks that show the same, under ``block_key``. A holder
    counts as one more page that shows something else, so its blocks need more
    pages to be taken for chrome. Only a block's own text goes by this, never what
    is below it, so a text's depth costs nothing and ``decay`` decides nothing."""
    per_face = (counts.groupBy("host", "node", "seen")
                .agg(F.sum(1 - F.col("one")).alias("c"), F.count(F.lit(1)).alias("all"), F.max("one").alias("one"),
                     F.max("held").alias("held")))
    # faces on few pages can't be of low importance as blocks of their own, so a path's are summed up; what is left is
    # read twice and short
    often = F.when((F.col("one") == 1) & (F.col("all") >= least_pages), F.col("seen"))
    sums = stored(per_face.groupBy("host", "node", often.alias("seen"))
                  .agg(F.sum("c").alias("c"), F.sum(F.when(F.col("c") > 0, F.col("c") * F.ln("c"))).alias("s"), F.max("all").alias("all"),
                       F.max("held").alias("held")))
    own = (sums.groupBy("host", "node")
           .agg(F.sum("c").alias("n"), (F.sum("c") + F.max("held")).alias("m"), F.sum("s").alias("s"))
           .withColumn("own", F.when(F.col("n") < least_pages, F.lit(1.0))
                       .otherwise((F.ln("m") - F.col("s") / F.col("m")) / F.ln("m"))))
    own = own.select("host", "node", "m", "own")
    alike = (sums.filter("seen is not null").join(own.filter(F.col("own") >= low), ["host", "node"])
             .filter(1 - F.col("all") * F.ln("all") / (F.col("m") * F.ln("m")) < low)
             .select("host", (-F.col("node").bitwiseXOR(F.shiftright("seen", 1)) - 1).alias("node")))
    return own.filter(F.col("own") < low).select("host", "node").unionByName(alike)


def dealt(rows: DataFrame, low_nodes: DataFrame) -> DataFrame:
    """``rows`` with the list of their host, if it has one. At most ``HOT_SHARE`` hosts can hold more than
    a ``HOT_SHARE``-th of all pages, so the table of hot hosts is broadcast and the copies
    of their lists are at most twice as many."""
    share = F.col("n") * HOT_SHARE / F.lit(max(rows.count(), 1))
    hot = (rows.groupBy("host").agg(F.count(F.lit(1)).alias("n")).filter(share > 1)
           .select(F.col("host").alias("_hot"), F.ceil(share).alias("_parts")))
    parts = F.coalesce("_parts", F.lit(1).cast("long"))

    def with_parts(df):
        return df.join(F.broadcast(hot), F.col("host") == F.col("_hot"), "left")
    rows = with_parts(rows).withColumn("_part", F.pmod(F.xxhash64("_id", "html"), parts)).drop("_hot", "_parts")
    low_nodes = (with_parts(low_nodes).withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
                 .select("host", "_part", "low"))
    return rows.join(low_nodes, ["host", "_part"], "left")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              low: float = LOW, decay: float = DECAY, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``(id, url, text, n_chars)`` for every page: the text of the branches that
    the host's style tree keeps, in page order.

    A null html is the empty page, whose text is empty; pages without a host
    (null url) form one site. Where a page has an ``article`` or ``main``, only
    what these hold without chrome is looked at; blocks below ``low`` lose their text, be it as a path
    or as one of the blocks that repeat under it.
    A node seen on fewer than ``least_pages`` pages has importance 1. Equal rows
    are pages of their own; other columns are not read. Hosts meet their
    branches in an equi-join; a host with more than a ``HOT_SHARE``-th of all pages
    is dealt over as many parts as it has such shares, each with a copy of its list.
    """
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("_url"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("host", url_host(F.col("_url")))
    low_nodes = (low_branches(branch_counts(rows), low, decay, least_pages)
                 .groupBy("host").agg(F.collect_list("node").alias("low")))
    known = dealt(rows, low_nodes)

    def run(batches):
        for batch in batches:
            texts = [text_of(parse(page), set(cut or ()))
                     for page, cut in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[id_col, url_col, "text", "n_chars"])

    kind = rows.schema["_id"].dataType.simpleString()
    return map_arrow(known.select("_id", "_url", "html", "low"), run,
                     f"`{id_col}` {kind}, `{url_col}` string, text string, n_chars long")


def op5_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
