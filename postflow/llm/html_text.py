"""Main text of web pages by a site style tree (operator 7).

1. One pass parses every whole page into blocks of text. A block's node is its host and its path of
   presentation signatures (tag, class and id without digits). Per element of the page the pass
   also records the sequence of its children's signatures (presentation) and, per block, a hash of
   its text (content).
2. Merging the pages of a host is counting: pages per (node, presentation) and (node, content),
   exact copies of a page once. Counts are combined in every task before they are exchanged, so a
   host with a third of all pages is spread over its features. With ``m`` pages, a node's
   presentation importance is the entropy (base m) of its child sequences; a content node's
   importance is 1 minus how widely each of its texts is shared (the mean of log_m of the pages that
   show it); a text's is 1 minus log_m of the pages that show it there. A block's importance is the
   mean of its content's (the lesser of its text's and its node's) and its parent's presentation
   importance; 1 where one page only has the node.
3. Branches that markup marks as menu, header, footer, side bar, notice, advert, form, script, style
   or reader comments have importance 0: by their element or role, or by a class or id that says so as a
   whole (``ad``, ``post-comments``, but not ``no-sidebar``). A class, an id or a form does not count where the
   branch holds the page's article or main element, or more than half of the text it stands in (that of the
   article, or of a page without one). Every other block is judged, and kept from
   ``least_importance`` on; a page's ``article`` (else ``main``) branches weigh in its importance.
   Inside them it counts ``INSIDE`` times, and as if ``INSIDE_PAGES`` pages more spoke for the block,
   so few pages that share a text do not drop it. Outside, where they hold at least half of the
   page's text, it counts by the share that they do not hold; where they hold less (teasers beside
   the text), as on a page without them.

Edge cases: null and empty pages give an empty text; pages without a host share the host ''; tags
that never close end with the page; repeated rows give a row each; a null url is kept; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postflow.llm.tables import staged, table

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*(?:>|\Z)",
    re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

#: Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre "
    "section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - frozenset("body caption dd dt html li tbody td tfoot th thead tr".split()) | {"p"}
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
        "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"},
         "th": {"table"}, "option": {"select"}}

DROPPED_TAGS = frozenset("nav aside footer button select textarea svg dialog object canvas "
                         "audio video menu".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())
DROPPED_NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header footer masthead sidebar aside ad ads "
    "advert adverts advertisement advertising banner sponsor sponsored promo cookie cookies consent "
    "gdpr notice newsletter subscribe signup login share sharing social comment comments disqus "
    "replies related recommended popup modal overlay pagination pager search skip".split())
#: Words that may stand beside such a name in one class or id.
QUALIFIERS = frozenset(
    "a area bar block bottom box container content global inner item items left links list main outer page post "
    "primary reader right secondary section site sub text top user widget wrap wrapper".split())


#: Weight of a page's article or main branches in the importance of the blocks inside them.
INSIDE, INSIDE_PAGES = 4.0, 2.0


def says(name: str, inside: bool) -> bool:
    """Whether a class or id as a whole names what is no main text; a header inside an article does not."""
    words = set(re.split(r"[^a-z]+", name)) - {""}
    named = words & DROPPED_NAMES
    return bool(named) and words <= DROPPED_NAMES | QUALIFIERS and not (inside and named == {"header"})


class Node:
    __slots__ = ("tag", "sign", "dropped", "named", "main", "children", "path")

    def __init__(self, tag: str, attributes: str, parent: "Node | None"):
        names, roles = "", set()
        for m in ATTRIBUTE.finditer(attributes) if attributes else ():
            value = html.unescape(m[2] or m[3] or m[4] or "").lower()
            if m[1].lower() == "role":
                roles |= set(value.split())
            else:
                names += " " + re.sub(r"\d+", "", value)
        self.tag = tag
        self.sign = tag + names
        inside = parent is not None and parent.main
        self.dropped = (parent is not None and parent.dropped) or (
            tag in DROPPED_TAGS or bool(roles & DROPPED_ROLES) or (tag == "header" and not inside))
        #: The branches by class, id or form that this node is in, itself included.
        self.named = parent.named if parent is not None else ()
        if tag == "form" or (tag not in ("html", "body", "article", "main") and any(says(n, inside) for n in names.split())):
            self.named += (self,)
        self.main = tag if tag in ("article", "main") and not self.dropped else parent.main if inside else ""
        if self.main and inside and parent.main == "article":
            self.main = "article"
        self.children: list[str] = []
        self.path = xxhash.xxh64_intdigest(self.sign.encode(), parent.path if parent else 0)


def parse(page: str, host: str) -> tuple[list[tuple[str, int, int, str, bool]], list[tuple[int, int]]]:
    """Blocks ``(text, node, parent node, main container, dropped)`` in page order, and
    ``(node, child sequence)`` of the elements that are not dropped."""
    root = Node("", "", None)
    root.path = xxhash.xxh64_intdigest(host.encode(), 7)
    stack, blocks, styles, words = [root], [], [], []
    holds: set[Node] = set()  # named branches that hold an article or main element

    def owner() -> int:
        return next(i for i in range(len(stack) - 1, -1, -1) if i == 0 or stack[i].tag in BLOCK)

    def flush() -> None:
        text = " ".join("".join(words).split())
        words.clear()
        if text:
            i = owner()
            node = stack[i]
            blocks.append((text, node.path, stack[max(0, i - 1)].path, node.main, node.dropped, node.named))

    def pop_to(depth: int) -> None:
        while len(stack) > depth:
            if stack[-1].tag in BLOCK:
                flush()
            node = stack.pop()
            if node.children and not node.dropped:
                runs = [c for i, c in enumerate(node.children) if not i or c != node.children[i - 1]]
                styles.append((node.path, xxhash.xxh64_intdigest("\n".join(runs).encode()), node.named))

    def close(tags, scope) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                return pop_to(i)
            if stack[i].tag in scope:
                return None
        return None

    at = 0
    while True:
        m = TOKEN.search(page, at)
        if m is None:
            words.append(html.unescape(page[at:]))
            break
        if m.start() > at:
            words.append(html.unescape(page[at:m.start()]))
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            close({tag}, () if tag != "p" else {"table"})
            if tag in BLOCK:
                flush()
            continue
        if tag in ("br", "hr"):
            words.append(" ")
        if tag in CLOSES_P:
            close({"p"}, {"table", "td", "th", "button"})
        if tag in ENDS:
            close(ENDS[tag], SCOPE[tag])
        if tag in BLOCK:
            flush()
        node = Node(tag, m[3], stack[-1])
        if tag in ("article", "main") and not node.dropped:
            holds.update(node.named)
        stack[-1].children.append(node.sign)
        if tag in VOID or m[3].endswith("/") and tag not in BLOCK:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        stack.append(node)
    flush()
    pop_to(1)
    sizes: dict = dict.fromkeys((True, False), 0)
    for text, _, _, main, dropped, named in blocks:
        if not dropped:
            for part in (bool(main), *named):
                sizes[part] = sizes.get(part, 0) + len(text)

    def goes(branch: Node) -> bool:
        if branch in holds:
            return False
        if branch.main or not sizes[True]:
            return 2 * sizes.get(branch, 0) <= sizes[bool(branch.main)]
        return True  # beside the article

    verdicts = {branch: goes(branch) for branch in {n for b in blocks for n in b[5]} | {n for t in styles for n in t[2]}}
    return [(*b[:4], b[4] or any(verdicts[n] for n in b[5])) for b in blocks], \
        [t[:2] for t in styles if not any(verdicts[n] for n in t[2])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


PARSED = ("rid long, page_id long, url string, copy long, "
          "blocks array<struct<text:string,node:long,parent:long,feature:long,mark:double>>, "
          "features array<struct<node:long,kind:boolean,feature:long>>")
_BLOCK = pa.list_(pa.struct([("text", pa.string()), ("node", pa.int64()), ("parent", pa.int64()),
                             ("feature", pa.int64()), ("mark", pa.float64())]))
_FEATURE = pa.list_(pa.struct([("node", pa.int64()), ("kind", pa.bool_()), ("feature", pa.int64())]))


def page_blocks(page: str | None, url: str | None) -> tuple[list[dict], list[dict], list[dict]]:
    """Blocks inside the page's article or main branches (all blocks, if it has none), the page's
    features, each once, and the blocks outside. ``mark`` is the weight of the semantic markup."""
    try:
        host = urlsplit(url or "").hostname or ""
    except ValueError:
        host = ""
    blocks, styles = parse(page or "", host)
    blocks = [b[:4] for b in blocks if not b[4]]
    mains = {b[3] for b in blocks if b[3]}
    main = "article" if "article" in mains else "main" if "main" in mains else ""
    share = sum(len(b[0]) for b in blocks if b[3] == main) / max(1, sum(len(b[0]) for b in blocks))
    outside = 1 - share if share >= 0.5 else 1.0
    split: tuple[list[dict], list[dict]] = ([], [])
    features = set()
    for pos, (text, node, parent, inside) in enumerate(blocks):
        feature = _signed(xxhash.xxh64_intdigest(text.encode()))
        features.add((_signed(node), True, feature))
        split[inside != main].append(
            {"pos": pos, "text": text, "node": _signed(node), "parent": _signed(parent), "feature": feature,
             "mark": 1.0 if not main else INSIDE if inside == main else outside})
    features |= {(_signed(node), False, _signed(style)) for node, style in styles}
    return split[0], [{"node": n, "kind": k, "feature": f} for n, k, f in sorted(features)], split[1]


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 512):
            part = batch.slice(lo, 512)
            pages = [page_blocks(p, u) for p, u in zip(part.column(3).to_pylist(), part.column(2).to_pylist())]
            blocks = [sorted(p[0] + p[2], key=lambda b: b["pos"]) for p in pages]
            copies = [_signed(xxhash.xxh64_intdigest(repr([(b["node"], b["feature"]) for b in found]).encode()))
                      for found in blocks]
            yield pa.record_batch(
                [part.column(0), part.column(1).cast(pa.int64()), part.column(2), pa.array(copies, pa.int64()),
                 pa.array(blocks, _BLOCK), pa.array([p[1] for p in pages], _FEATURE)],
                ["rid", "page_id", "url", "copy", "blocks", "features"])


def _shared(parsed: DataFrame) -> DataFrame:
    """Pages per feature of a node."""
    seen = parsed.select(F.explode("features").alias("f")).select("f.*")
    return seen.groupBy("node", "kind", "feature").agg(F.count("*").alias("c"))


def node_importance(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Importance of content nodes and of presentation nodes, ``(node, importance)`` each."""
    features = _shared(parsed).groupBy("node", "kind").agg(
        F.sum("c").alias("n"), F.sum(F.col("c") * F.log("c")).alias("clogc"),
        F.sum(F.log("c")).alias("logc"), F.count("*").alias("features"))
    shown = F.array_distinct(F.transform(F.filter("features", lambda f: f["kind"]), lambda f: f["node"]))
    pages = parsed.select(F.explode(shown).alias("node")).groupBy("node").agg(F.count("*").alias("m"))
    content = features.filter("kind").join(pages, "node").select("node", F.when(
        F.col("m") > 1, 1 - F.col("logc") / F.col("features") / F.log("m")).otherwise(1.0).alias("content"), "m")
    style = features.filter("NOT kind").select("node", F.when(
        F.col("n") > 1, 1 - F.col("clogc") / F.col("n") / F.log("n")).otherwise(1.0).alias("style"))
    return content, style


def extract_main_text(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html",
                      least_importance: float = 0.4) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row: kept blocks in page order, joined by newlines."""
    rows = pages.select(F.monotonically_increasing_id().alias("rid"), F.col(f"`{key}`").alias("page_id"),
                        F.col(f"`{url}`").cast("string").alias("url"),
                        F.col(f"`{page}`").cast("string").alias("html"))
    parsed = staged(rows.mapInArrow(_parsed, PARSED), "pages-parsed")
    first = parsed.groupBy("copy").agg(F.min("rid").alias("rid")).select("rid")
    distinct = parsed.select("rid", "features").join(first, "rid", "left_semi")
    content, style = node_importance(distinct)
    texts = _shared(distinct).filter("kind AND c > 1").select("node", "feature", "c")
    # Only places and hashes are joined with the counts; a page's texts stay in its row.
    places = parsed.select("rid", F.posexplode(F.transform("blocks", lambda b: F.struct(
        b["node"].alias("node"), b["parent"].alias("parent"), b["feature"].alias("feature"),
        b["mark"].alias("mark")))).alias("pos", "b")).select("rid", "pos", "b.*")
    one = F.lit(1.0)
    own = F.when(F.col("c").isNull() | (F.col("m") < 2), one).otherwise(1 - F.log("c") / F.log("m"))
    importance = (F.col("mark") * (F.least(own, F.coalesce("content", one)) + F.coalesce("style", one)) / 2
                  + F.when(F.col("mark") > 1, INSIDE_PAGES / F.coalesce("m", one)).otherwise(0.0))
    lost = (places.join(texts, ["node", "feature"], "left").join(content, "node", "left")
            .join(style.withColumnRenamed("node", "parent"), "parent", "left")
            .filter(importance < least_importance)
            .groupBy("rid").agg(F.collect_set("pos").alias("lost")))
    lost = staged(lost, "pages-lost")  # its size is known: texts are exchanged only if it is large
    kept = F.when(F.col("lost").isNull(), F.col("blocks")).otherwise(
        F.filter("blocks", lambda b, i: ~F.array_contains("lost", i)))
    return (parsed.select("rid", "page_id", "url", F.transform("blocks", lambda b: b["text"]).alias("blocks"))
            .join(lost, "rid", "left")
            .select("page_id", "url", F.array_join(kept, "\n").alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))
