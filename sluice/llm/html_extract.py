"""Main-text extraction with removal of site templates.

Every page is read once, in time linear in its length, into blocks of text and a table of the
elements around them: each block names its innermost box, each box its parent. A box's subtree hash
mixes its tag, its text and its children's hashes. Spark counts, per host, on how many
pages a subtree recurs; blocks within a box that recurs on many pages of the host are template and go.

Boilerplate elements go in any case: controls, scripts and the like always; forms, navigation, headers, footers,
asides, and what a role, class or id marks as such, unless they stand around the page's main
content (a page-wide form, a ``main`` in a ``sidebar`` wrapper). A class or id marks by its head word:
``left-sidebar`` is a sidebar, ``has-sidebar`` and ``sidebar-layout`` are not. Reader comments also go by structure: boxes under a heading
that announces comments, and runs of dated items of one kind behind the text.

The main text is that of all top-level articles, or the whole page where
they hold less than half of what is no template; an article that recurs goes where others stay. Pages count as different by their whole main text, so
exact copies of an article do not make its own parts a template, while a heading that is
template itself hides nothing. Running text directly in an article is kept however often
it repeats; boxes within it are subject to the count.

Counts are combined before the shuffle (one row per host, subtree and main text), so a host
with a third of all pages is spread. Only pages whose text can change move again.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import drop_saved, join_one, save
from sluice.llm.tokens import BATCH_BYTES

# HTML's element kinds, and the words that mark boilerplate.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section summary table tbody td tfoot th thead tr ul".split())
BOXES = frozenset("aside center details dialog dir div dl fieldset figure footer form header menu nav ol section table ul".split())
ROOTS = frozenset("html body article main".split())
#: Elements whose end is implied when one of the second kind begins right in them.
IMPLIED = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "option": {"option", "optgroup"},
    "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"}, "head": {"body"}}
#: Always dropped.
CONTROLS = frozenset(
    "applet audio button canvas datalist head iframe input math meter noembed noframes "
    "noscript object output progress script select style svg template textarea title video".split())
#: Dropped unless the page's main content stands in them; a header only outside articles.
FRAMES = frozenset("aside dialog footer form header menu nav search".split())
DROPPED_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar".split())
DROPPED_WORDS = frozenset(
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs consent cookie cookies "
    "copyright footer gdpr masthead menu modal nav navbar navigation newsletter notice notices notification "
    "pagination popup promo promoted promotion related share sharing sidebar signup social sponsor sponsored subscribe".split())
COMMENT_WORDS = frozenset("comment comments disqus discussion replies respond".split())
#: Words behind the head word of a class or id: parts and places of a box.
TAILS = frozenset(
    "area bar block body bottom box button buttons center col column container content entry form global group holder info inline inner item items left "
    "link links list main outer panel placeholder post posts primary right row secondary section site slot the title top unit widget widgets wrap wrapper zone".split())
#: A class or id with one of these words says something about what stands beside a box.
STATES = frozenset("body has hide hidden is layout no not open page show toggle with without".split())
#: Classes that mean one thing wherever their words stand.
ALWAYS = ("adsbygoogle", "cookie", "gdpr")
COMMENT_HEADING = re.compile(
    r"\W*(?:\d+\W+)?(?:(?:reader|user)s? )?(?:comments?|replies|responses|leave a (?:reply|comment)|kommentare?|antworten|commentaires?|réponses|comentarios?|respuestas)\W*(?:\d+\W*)?",
    re.IGNORECASE)
DATE = re.compile(r"\b(?:19|20)\d\d\b|\b\d{1,2}[./-]\d{1,2}[./-]\d{2,4}\b|\b\d{1,2}:\d\d\b|\b\d+ (?:minute|hour|day|week|month|year)s? ago\b", re.IGNORECASE)
#: Dated items of one kind that make a run, and the longest text of an item's first block (its author).
COMMENT_RUN = 3
AUTHOR_CHARS = 60

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))|[^>=]++|=)*+)(?:>|\Z)"
    r"|(?P<text>[^<]++|<)", re.DOTALL)
_MARKS = re.compile(r"""(?:^|[\s"'/])(class|id|role|itemprop|itemtype)\s*=\s*(?:"([^"]*)|'([^']*)|([^\s"'>]+))""", re.IGNORECASE)
_WORDS = re.compile(r"[a-z]+")
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Kinds of marks on an element.
FRAME, COMMENTS = 1, 2


def _kind_of(token: str, in_article: bool) -> int:
    """What a class or id says: FRAME, COMMENTS or 0."""
    words = [w for w in _WORDS.findall(token) if len(w) > 1]
    if not words or not STATES.isdisjoint(words[:1]) or "layout" in words or words[-1] == "open":
        return 0
    if any(w.startswith(a) for w in words for a in ALWAYS):
        return FRAME
    while len(words) > 1 and words[-1] in TAILS:
        words.pop()
    head = words[-1]
    for n in range(len(head) - 1, 1, -1):  # two words written as one: commentlist, navwrap
        if head[n:] in TAILS and (head[:n] in DROPPED_WORDS or head[:n] in COMMENT_WORDS):
            head = head[:n]
            break
    if head in COMMENT_WORDS:
        return COMMENTS
    return FRAME if head in DROPPED_WORDS or (head == "header" and not in_article) else 0


def _mark(tag: str, rest: str, in_article: bool) -> int:
    """The mark of an element by its tag, role, class or id."""
    found = FRAME if tag in FRAMES and (tag != "header" or not in_article) else 0
    if "=" not in rest or tag in ("html", "body", "main"):
        return found
    for m in _MARKS.finditer(rest):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "role":
            kinds = [FRAME] if value.strip() in DROPPED_ROLES else []
        elif name in ("itemprop", "itemtype"):
            kinds = [COMMENTS] if value.strip().rsplit("/", 1)[-1] in ("comment", "usercomments") else []
        else:
            kinds = [_kind_of(t, in_article or tag == "article") for t in value.split()]
        found = max([found, *kinds])
    return found


class Page:
    """A page as it was read: blocks of text and the elements around them, parents first.

    ``blocks`` are (text, element); of element ``i``, ``tag``, ``up`` (parent or -1), ``mark``, ``digest``,
    ``before`` and ``size`` (characters of the blocks before and in it) and ``article`` (it is, or stands in, one)."""

    __slots__ = ("blocks", "tag", "up", "mark", "digest", "before", "size", "article")

    def __init__(self):
        self.blocks: list[tuple[str, int]] = []
        self.tag, self.up, self.mark, self.digest, self.before, self.size, self.article = [], [], [], [], [], [], []


def read_page(page: str) -> Page:
    """Blocks and elements of a page, in one pass; nothing is searched twice, so the time is
    linear in the page's length whatever its tags do.

    Tolerant of what real pages hold: missing, stray and crossed end tags, unclosed
    comments and quotes, and a text cut off anywhere."""
    out = Page()
    stack: list[tuple[int, str, object, bool]] = []  # element, tag, hash, in a control
    places: dict[str, list[int]] = {}  # places of the open elements of each tag in the stack
    block_places: list[int] = []  # those of block elements
    pending: list[str] = []
    total = 0

    def flush() -> None:
        nonlocal total
        if pending:
            text = " ".join("".join(pending).split())
            pending.clear()
            if text:
                out.blocks.append((text, stack[-1][0] if stack else -1))
                total += len(text)

    def close(to: int, block: bool = True) -> None:
        if block:
            flush()
        while len(stack) > to:
            i, tag, digest, _ = stack.pop()
            places[tag].pop()
            if block_places and block_places[-1] == len(stack):
                block_places.pop()
            out.digest[i] = digest.intdigest() - (1 << 63)
            out.size[i] = total - out.before[i]
            if stack:
                stack[-1][2].update(digest.digest())

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.match(page, at)
        at = m.end()
        text, tag = m["text"], m["tag"]
        if text is not None:
            text = html.unescape(text)
            if not stack or not stack[-1][3]:
                pending.append(text)
            if stack and not text.isspace():
                stack[-1][2].update(text.encode("utf-8", "surrogatepass"))
            continue
        if tag is None:
            continue
        tag = tag.lower()
        if m["end"]:
            open_at = places.get(tag)
            if open_at and (tag in BLOCK or not block_places or open_at[-1] > block_places[-1]):  # else a stray end
                close(open_at[-1], tag in BLOCK)
            if tag in BLOCK:
                flush()
            continue
        if tag == "br":
            pending.append(" ")
            continue
        if tag in BLOCK:
            flush()
            if block_places:  # what this start tag ends
                around = stack[block_places[-1]][1]
                if around == "p" or tag in IMPLIED.get(around, ()):
                    close(block_places[-1])
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.IGNORECASE).search(page, at)
            at = end.start() if end else n
            end = page.find(">", at) if end else -1
            at = end + 1 if end >= 0 else n
            continue
        up = stack[-1][0] if stack else -1
        inside = up >= 0 and out.article[up]
        control = bool(stack) and stack[-1][3] or tag in CONTROLS
        i = len(out.tag)
        out.tag.append(tag)
        out.up.append(up)
        out.mark.append(0 if control or tag not in BLOCK and tag not in FRAMES else _mark(tag, m["rest"], inside))
        out.article.append(inside or tag in ("article", "main"))
        out.digest.append(0)
        out.before.append(total)
        out.size.append(0)
        if tag in BLOCK:
            block_places.append(len(stack))
        places.setdefault(tag, []).append(len(stack))
        stack.append((i, tag, xxhash.xxh64(tag), control))
    close(0)
    return out


def _comment_boxes(page: Page) -> set[int]:
    """Elements that hold reader comments by their structure."""
    found, children = set(), {}
    for i, up in enumerate(page.up):
        children.setdefault(up, []).append(i)
    first: dict[int, str] = {}
    dated: set[int] = set()
    announced: set[int] = set()
    for text, e in page.blocks:
        date = len(text) <= 200 and DATE.search(text) is not None
        # A block belongs to the items it begins or dates: up to four elements around it.
        for _ in range(4):
            if e < 0 or (e in first and not date):
                break
            first.setdefault(e, text)
            if date:
                dated.add(e)
            e = page.up[e]
    for i, tag in enumerate(page.tag):
        if tag in _HEADINGS and first.get(i) and COMMENT_HEADING.fullmatch(first[i]):
            box = page.up[i]
            around = children.get(box, [])
            if box >= 0 and page.tag[box] not in ("html", "body", "main", "article") and around[0] == i:
                found.add(box)
            elif box not in announced:
                announced.add(box)
                found.update(c for c in around if c >= i)
        elif tag == "time" and page.up[i] >= 0:
            dated.update((page.up[i], page.up[page.up[i]]))
    whole = sum(len(t) for t, _ in page.blocks)
    for up, items in children.items():
        run: list[int] = []
        for i in [*items, None]:
            if i is not None and i in dated and page.size[i] and page.tag[i] in ("li", "div", "section", "article", "dd") and (
                    not run or page.tag[run[0]] == page.tag[i]) and len(first.get(i, "")) <= min(AUTHOR_CHARS, page.size[i] - 1):
                run.append(i)
                continue
            # Comments follow a text longer than they are; a list of posts is the text.
            if len(run) >= COMMENT_RUN and run[0] > 0 and 2 * sum(page.size[k] for k in run) < whole:
                if 2 * page.before[run[0]] >= whole:
                    found.update(run)
            if i is not None:
                run = []
    return found


def blocks_of(page: Page) -> tuple[list[tuple[str, int, int]], list[tuple[int, int]], list[int]]:
    """What is left of a page without boilerplate: its blocks (text, owner or -1, article or -1), its owners
    (hash, owner around or -1), parents first, and the hashes of its top-level articles."""
    n = len(page.tag)
    comments = _comment_boxes(page)
    mark = [COMMENTS if i in comments else m for i, m in enumerate(page.mark)]
    # The main content keeps what stands around it: the longest article and the longest main outside
    # all marked elements, or else a marked one with more text than all that is not marked.
    around, commented = [0] * n, [False] * n
    for i in range(n):
        up = page.up[i]
        around[i] = (around[up] if up >= 0 else 0) + (mark[i] > 0)
        commented[i] = mark[i] == COMMENTS or (up >= 0 and commented[up])
    plain = sum(len(t) for t, e in page.blocks if e < 0 or not around[e])
    rescued: set[int] = set()
    for tag in ("article", "main"):
        best = max((i for i in range(n) if page.tag[i] == tag and not commented[i]), key=lambda i: (not around[i], page.size[i], -i), default=-1)
        if best >= 0 and around[best] and page.size[best] >= max(plain, 1):
            i = best
            while i >= 0:
                rescued.add(i)
                i = page.up[i]
    if not any(t in ("article", "main") for t in page.tag):  # a form around the whole page
        whole = sum(len(t) for t, _ in page.blocks)
        rescued.update(i for i in range(n) if page.tag[i] == "form" and 2 * page.size[i] >= whole > 2 * plain)
    gone, root, owner = [False] * n, [-1] * n, [-1] * n
    articles: list[int] = []
    owners: list[tuple[int, int]] = []
    for i in range(n):
        up, tag = page.up[i], page.tag[i]
        gone[i] = up >= 0 and gone[up] or mark[i] > 0 and i not in rescued
        if gone[i]:
            continue
        root[i] = root[up] if up >= 0 else -1
        if root[i] < 0 and tag in ("article", "main"):
            root[i] = len(articles)
            articles.append(page.digest[i])
            owner[i] = owner[up] if up >= 0 else -1
            continue
        owner[i] = owner[up] if up >= 0 else -1
        if tag in BOXES if root[i] >= 0 else tag in BLOCK and tag not in ROOTS:
            owners.append((page.digest[i], owner[i]))
            owner[i] = len(owners) - 1
    left = [(t, owner[e] if e >= 0 else -1, root[e] if e >= 0 else -1) for t, e in page.blocks if e < 0 or not gone[e]]
    used = {a for _, _, a in left if a >= 0}
    return left, owners, [d for i, d in enumerate(articles)] if used else []


def main_text(blocks: list[tuple[str, int, int]], owners: list[tuple[int, int]], articles: list[int], hit: set[int] = frozenset()) -> str:
    """The text of the blocks outside recurring subtrees (``hit``): of all top-level articles, or of the whole page
    where they hold less than half of it."""
    if hit:
        dead: list[bool] = []
        for digest, up in owners:
            dead.append(digest in hit or (up >= 0 and dead[up]))
        blocks = [b for b in blocks if b[1] < 0 or not dead[b[1]]]
        some = [b for b in blocks if b[2] < 0 or articles[b[2]] not in hit]
        if any(b[2] >= 0 for b in some):
            blocks = some
    own = [b[0] for b in blocks if b[2] >= 0]
    every = [b[0] for b in blocks]
    return "\n\n".join(own if 2 * sum(map(len, own)) >= sum(map(len, every)) else every)


def page_text(page: str | None) -> str:
    """The main text of a page by itself, no host known."""
    return main_text(*blocks_of(read_page(page or "")))


def _read_pages(html_at: int, keep: list[int]):
    block = pa.struct([("text", pa.string()), ("owner", pa.int32()), ("article", pa.int32())])
    owner = pa.struct([("digest", pa.int64()), ("up", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, found, mains, tables, roots, subtrees, size = 0, [], [], [], [], [], 0
            for i, page in enumerate(batch.column(html_at)):
                blocks, owners, articles = blocks_of(read_page(page.as_py() or ""))
                main = main_text(blocks, owners, articles)
                mains.append(xxhash.xxh64_intdigest(main.encode("utf-8", "surrogatepass")) - (1 << 63))
                found.append([{"text": t, "owner": o, "article": a} for t, o, a in blocks])
                tables.append([{"digest": d, "up": u} for d, u in owners])
                roots.append(articles)
                holding, seen = {o for _, o, _ in blocks if o >= 0}, set()
                for o in sorted(holding, reverse=True):  # boxes around blocks, each once
                    while o >= 0 and o not in seen:
                        seen.add(o)
                        o = owners[o][1]
                subtrees.append(list({owners[o][0] for o in seen} | (set(articles) if len(articles) > 1 else set())))
                size += sum(len(b[0]) + 16 for b in blocks) + 12 * len(owners)
                if size >= BATCH_BYTES or i == batch.num_rows - 1:
                    part = batch.slice(low, len(found))
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(k) for k in keep), pa.array(found, pa.list_(block)), pa.array(tables, pa.list_(owner)),
                         pa.array(roots, pa.list_(pa.int64())), pa.array(mains, pa.int64()), pa.array(subtrees, pa.list_(pa.int64()))],
                        [*(batch.schema.names[k] for k in keep), "blocks", "owners", "articles", "main_text", "subtrees"])
                    low, found, mains, tables, roots, subtrees, size = i + 1, [], [], [], [], [], 0

    return run


def _cut_pages(n_keep: int):
    """The main text of pages (their columns, blocks, owners, articles, hit), in batches bounded by its size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, made, size = 0, [], 0
            for i in range(batch.num_rows):
                blocks, owners, articles, hit = (batch.column(n_keep + k)[i].as_py() for k in range(4))
                made.append(main_text([(b["text"], b["owner"], b["article"]) for b in blocks],
                                      [(o["digest"], o["up"]) for o in owners] if hit else [], articles, set(hit or ())))
                size += len(made[-1])
                if size >= BATCH_BYTES or i == batch.num_rows - 1:
                    part = batch.slice(low, len(made))
                    yield pa.RecordBatch.from_arrays([*part.columns[:n_keep], pa.array(made, pa.string())], [*batch.schema.names[:n_keep], "text"])
                    low, made, size = i + 1, [], 0

    return run


def host_of(url: str) -> Column:
    """The host of a URL in lower case, without user and port; null if there is none."""
    host = F.lower(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def recurring_subtrees(pages: DataFrame, min_pages: int = 5, min_share: float = 0.005) -> DataFrame:
    """``host, subtree`` of subtrees on at least ``min_pages`` and ``min_share`` of the host's
    pages, pages of one main text counting once. Input: ``host, main_text`` (its hash) and ``subtrees``."""
    texts = pages.select("host", "main_text").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    counts = pages.select("host", "main_text", F.explode("subtrees").alias("subtree")).distinct().groupBy("host", "subtree").agg(
        F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_pages)
    counts = counts.withColumnRenamed("host", "of")
    return counts.join(texts, F.col("of").eqNullSafe(F.col("host"))).filter(
        F.col("n") >= min_share * F.col("pages")).select("host", "subtree")


def extract_text(pages: DataFrame, html: str = "html", url: str = "url", out: str = "text", min_pages: int = 5,
                 min_share: float = 0.005) -> DataFrame:
    """``pages`` without the html column, with ``out``: the main text, blocks joined by a blank line.

    The main text is that of the top-level articles (or main elements) in their order, or the
    whole page where they hold less than half of the text, less boilerplate and template
    subtrees. Of several articles those that recur like a template go, unless all do. White space in a block is one space. A null,
    empty or blank page has an empty text. Pages without a host share the null host. Repeated
    rows stay and have equal texts; a column named ``out`` is replaced.
    """
    keep = [c for c in pages.columns if c != html and c.lower() != out.lower()]
    neutral = pages.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)], F.col(html).alias("html"), host_of(url).alias("host"))
    fields = [f for f in neutral.schema.fields if f.name != "html"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    at = [neutral.columns.index(f.name) for f in fields]
    read = neutral.mapInArrow(
        _read_pages(neutral.columns.index("html"), at),
        f"{schema}, blocks array<struct<text:string,owner:int,article:int>>, owners array<struct<digest:long,up:int>>, "
        "articles array<long>, main_text long, subtrees array<long>")
    read = save(read.withColumn("row", F.monotonically_increasing_id()), "page-blocks")
    template = save(recurring_subtrees(read.select("host", "main_text", "subtrees"), min_pages, min_share), "template-subtrees")
    site = F.coalesce("host", F.lit("")).alias("site")  # no host is empty
    owned = read.filter(F.size("subtrees") > 0).select("row", site, F.explode("subtrees").alias("subtree"))
    hit = save(join_one(owned, template.select(site, "subtree"), ["site", "subtree"]).groupBy(
        F.col("row").alias("hit_row")).agg(F.collect_set("subtree").alias("hit")), "template-hits")
    drop_saved(template)
    names = [f"c{i}" for i in range(len(keep))]
    given = [*names, "blocks", "owners", "articles"]
    plain = read.filter(F.size("subtrees") == 0).select(*given, F.lit(None).cast("array<long>").alias("hit"))
    cut = plain.unionByName(read.filter(F.size("subtrees") > 0).join(hit, F.col("row") == F.col("hit_row"), "left").select(*given, "hit"))
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in read.select(*names).schema.fields)
    return cut.mapInArrow(_cut_pages(len(names)), f"{kept}, text string" if kept else "text string").toDF(*keep, out)
