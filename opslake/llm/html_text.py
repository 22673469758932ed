"""Main text of web pages by site style trees.

Pages of one host are merged into a tree. Its nodes are element paths (tags with their class and
id, long numbers blanked); a node knows on how many different pages it occurs, in how many styles
(sequences of child elements) and with which texts. From that follow two entropies, to the base
of the number of pages:

- presentation: of the styles of a node. One style on all pages gives 0, another on every page 1;
- content: of each text over the pages it occurs on. A text of all pages has 1, a text of one
  page 0. A node's content importance is one less the mean over the texts in its branch.

The importance of a branch weighs both, the content by ``DAMP`` to the power of the kinds of
children. Branches of little importance on enough pages are removed from each page, next to
those that the markup itself declares to be no article: menus, page headers and footers, sidebars,
forms, scripts, notices, adverts and comments, by element, role or class. Copies of one page
count as one page, so that a page isn't noise because it was fetched often.

Trees are aggregates keyed by host, node and text or style, so a large host spreads like any
other data; branch sums are added to each node's ancestors in the merged tree, which needs no
pass per level.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from opslake.llm.common import map_arrow, stored

# Element names of HTML, and words that sites use in class and id.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol option p pre search section select summary table tbody tfoot thead tr ul".split()
)
CLOSES_P = BLOCKS - frozenset("body caption dd dt frameset head html legend option select tbody tfoot thead tr".split()) | {"dd", "dt"}
IN_HEAD = frozenset("base basefont bgsound head link meta noscript script style template title".split())
# A start tag ends an open element of these names, unless one of the containers lies between.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "datalist")),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("table", "tr")),
    "th": (("td", "th"), ("table", "tr")),
    "tbody": (("tbody", "thead", "tfoot", "tr", "td", "th"), ("table",)),
    "thead": (("tbody", "thead", "tfoot", "tr", "td", "th"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot", "tr", "td", "th"), ("table",)),
}
P_SCOPE = frozenset("table td th caption button object html".split())
NOISE_TAGS = frozenset(
    "aside audio button canvas datalist dialog embed footer form head iframe input menu nav noembed "
    "noframes noscript object option script search select style svg template textarea title video "
    "xmp".split()
)
NOISE_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search "
    "status tablist toolbar tooltip".split()
)
NOISE_WORDS = frozenset(
    "ad ads adbox adslot adsense advert adverts advertisement advertising breadcrumb breadcrumbs "
    "captcha comment comments commentlist consent cookie cookies copyright disqus donate footer "
    "gdpr login masthead menu modal nav navbar navigation newsletter notice notices notification "
    "outbrain overlay pager paginate pagination paywall popup popover promo reactions recommended "
    "recommendations related replies reply respond respondform search share sharebar sharedaddy sharing sidebar "
    "signin signup skip skiplink social sponsor sponsored submenu subscribe subscription taboola "
    "toolbar tooltip topbar".split()
)
# Said of parts of articles as well ("article-header"): noise only without a word of the next list.
WEAK_WORDS = frozenset("aside banner form header links meta rail tags widget widgets".split())
ARTICLE_WORDS = frozenset("article articlebody entry post postbody story".split())
GOOD_WORDS = ARTICLE_WORDS | frozenset("body content main text".split())

# The weight of content falls with the kinds of children to this power.
DAMP = 0.9
THRESHOLD = 0.3
MIN_PAGES = 3
# Elements further down count as children of the element at this depth, as in browsers.
MAX_DEPTH = 256
LINKS, LINK_SHARE = 3, 0.75
LISTS = frozenset("center dl div ol section table ul".split())

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)|</(?:>|[^a-zA-Z>][^>]*(?:>|\Z))"
    r"|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[\"'])*?)(?:>|\Z)",
    re.S,
)
_CLOSED = re.compile(r"(?:^|[\s\"'])/$")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NUMBERS, _LONG_NUMBERS = re.compile(r"\d+"), re.compile(r"\d{3,}")
_RUNS = re.compile(r"[A-Za-z]+")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_WATCHED = ("class", "id", "role", "hidden", "aria-hidden", "style", "itemprop")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Page:
    """The elements of a page in the order of their start tags, and its texts in page order.

    ``tag``, ``parent``, ``label`` (tag, class and id with long numbers blanked), ``noise`` (0 to 2: not
    declared as noise, by class or id, by element or role) and ``good`` (declared as the article)
    are lists by element; ``texts`` holds (block number, element, text).
    """

    def __init__(self, source: str):
        self.tag, self.parent, self.label = ["#page"], [-1], ["#page"]
        self.noise, self.good, self.depth = [0], [False], [0]
        self.texts: list[tuple[int, int, str]] = []
        self._declared: dict = {}
        self._read(source)

    def _open(self, name: str, attributes: str, parent: int) -> int:
        found = self._declared.get((name, attributes))
        if found is None:
            found = self._declared[name, attributes] = _declaration(name, attributes)
        label, noise, good = found
        self.tag.append(name)
        self.parent.append(parent)
        self.label.append(label)
        self.noise.append(noise)
        self.good.append(good)
        self.depth.append(self.depth[parent] + 1)
        return len(self.tag) - 1

    def _read(self, source: str) -> None:
        stack, names, block, at = [0], ["#page"], 0, 0
        texts, size = self.texts, len(source)
        # Where in the stack each name is open, and where blocks are.
        places: defaultdict[str, list[int]] = defaultdict(list)
        blocks: list[int] = []

        def begin(element: int, name: str) -> None:
            places[name].append(len(stack))
            if name in BLOCKS:
                blocks.append(len(stack))
            stack.append(element)
            names.append(name)

        def end(upto: int) -> None:
            nonlocal block
            while len(stack) > upto:
                stack.pop()
                places[names.pop()].pop()
            if blocks and blocks[-1] >= upto:
                block += 1
                while blocks and blocks[-1] >= upto:
                    blocks.pop()

        def last(wanted, limits) -> int:
            found = max((places[x][-1] for x in wanted if places[x]), default=0)
            if limits is BLOCKS:
                limit = blocks[-1] if blocks else 0
            else:
                limit = max((places[x][-1] for x in limits if places[x]), default=0)
            return found if found > limit else 0

        while at < size:
            start = source.find("<", at)
            if start < 0:
                start = size
            if start > at:
                text = source[at:start]
                if names[-1] == "head" and not text.isspace():
                    end(len(names) - 1)
                texts.append((block, stack[-1], text))
            if start == size:
                break
            match = _TOKEN.match(source, start)
            if match is None:
                texts.append((block, stack[-1], "<"))
                at = start + 1
                continue
            at = match.end()
            closed, opened, attributes = match.groups()
            if opened:
                name = opened.lower()
                if names[-1] == "head" and name not in IN_HEAD:
                    end(len(names) - 1)
                if name in CLOSES_P and (i := last(("p",), P_SCOPE)):
                    end(i)
                if name in ENDS and (i := last(*ENDS[name])):
                    end(i)
                if name in BLOCKS:
                    block += 1
                elif name in ("br", "td", "th"):
                    texts.append((block, stack[-1], " "))
                element = self._open(name, attributes, stack[-1])
                if name in RAW:
                    found = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(source, at)
                    stop = found.start() if found else size
                    texts.append((block, element, source[at:stop]))
                    at = (source.find(">", stop) + 1 or size) if found else size
                elif name in BLOCKS or not _CLOSED.search(attributes):
                    if name not in VOID:
                        begin(element, name)
            elif closed:
                name = closed.lower()
                # The end of an inline element doesn't end blocks within it.
                if i := last((name,), () if name in BLOCKS else BLOCKS):
                    end(i)
                elif name in BLOCKS:
                    block += 1
        for i, (number, element, text) in enumerate(texts):
            if "&" in text and self.tag[element] not in ("script", "style"):
                texts[i] = (number, element, entities.unescape(text))

    def paths(self) -> tuple[list[int], list[int]]:
        """A number for the path of each element, alike for elements with equal labels all the
        way up; and the element above it in that path."""
        out, above = [0] * len(self.tag), [0] * len(self.tag)
        shown = [0] * len(self.tag)  # the element itself, or the one at the greatest depth
        for i in range(1, len(self.tag)):
            above[i] = shown[self.parent[i]]
            out[i] = xxhash.xxh64_intdigest(self.label[i].encode(), out[above[i]]) >> 1
            shown[i] = i if self.depth[i] < MAX_DEPTH else above[i]
        return out, above


def _declaration(name: str, attributes: str) -> tuple[str, int, bool]:
    """Label of an element, how its markup declares noise, and whether it declares the article."""
    values: dict[str, str] = {}
    for key, *value in _ATTRIBUTE.findall(attributes):
        if key.lower() in _WATCHED:
            values.setdefault(key.lower(), "".join(value))
    named = " ".join(f"{values.get('class', '')} {values.get('id', '')}".split())
    # Ids are numbered by page or by comment, classes also by column: those numbers are short.
    kind = _LONG_NUMBERS.sub("#", " ".join(values.get("class", "").split()))
    label = f"{name}.{kind}#{_NUMBERS.sub('#', values.get('id', '').strip())}" if named else name
    role = values.get("role", "").strip().lower()
    hidden = (
        "hidden" in values
        or values.get("aria-hidden", "").lower() == "true"
        or _HIDDEN.search(values.get("style", ""))
    )
    # Words between other characters, and those that capitals set apart.
    words = {w.lower() for w in _RUNS.findall(named) + _WORDS.findall(named)}
    good_words = bool(words & GOOD_WORDS)
    noise = 0
    if name in NOISE_TAGS or role in NOISE_ROLES or hidden:
        noise = 2
    elif name not in ("html", "body", "main"):
        # Sites also list what goes with an article among its classes.
        strong = words & NOISE_WORDS and not (name == "article" and good_words)
        noise = int(bool(strong or words & WEAK_WORDS and not words & ARTICLE_WORDS))
    good = (
        name in ("article", "main")
        or role in ("article", "main")
        or values.get("itemprop", "").lower() == "articlebody"
        or good_words and name in ("div", "section", "td")
    )
    return label, noise, good


def _inherit(page: Page, flags: list[bool]) -> list[bool]:
    """Whether an element or one around it has the flag."""
    out = flags[:]
    for i in range(1, len(out)):
        out[i] = out[i] or out[page.parent[i]]
    return out


def _summed(page: Page, values: list[int]) -> list[int]:
    """The sum of the values in the branch of each element."""
    out = values[:]
    for i in range(len(out) - 1, 0, -1):
        out[page.parent[i]] += out[i]
    return out


def _sizes(page: Page, left_out: list[bool]) -> list[int]:
    """Characters of text that is not left out, blanks aside, of each element by itself."""
    out = [0] * len(page.tag)
    for _, element, text in page.texts:
        if not left_out[element]:
            out[element] += sum(map(len, text.split()))
    return out


def _up(page: Page, element: int) -> Iterator[int]:
    """The elements around one, innermost first."""
    while (element := page.parent[element]) > 0:
        yield element


def _removed(page: Page, unimportant: frozenset[int]) -> list[bool]:
    """Which elements lie in a branch that is not part of the article."""
    n, tag, parent, level = len(page.tag), page.tag, page.parent, page.noise[:]
    in_article, in_main = [False] * n, [False] * n
    for i in range(1, n):
        in_article[i] = in_article[parent[i]] or tag[parent[i]] == "article"
        in_main[i] = in_main[parent[i]] or tag[parent[i]] in ("article", "main")
        if tag[i] == "article" and in_article[i] or tag[i] == "header" and not in_main[i]:
            level[i] = 2  # an article within another is a comment on it
    # A class is no noise if its element holds the article: the first one that is named so, or
    # the title with half of the text.
    declared = _inherit(page, [x == 2 for x in level])
    sizes = _summed(page, _sizes(page, declared))
    for name in ("article", "main", "h1"):
        cores = (i for i in range(1, n) if tag[i] == name and not level[i] and not declared[i])
        for around in _up(page, next(cores, 0)):
            if level[around] == 1 and (name != "h1" or 2 * sizes[around] >= sizes[0]):
                level[around] = 0
    flags = [x > 0 for x in level]
    if unimportant:
        for i, path in enumerate(page.paths()[0]):
            plain = in_main[i] and page.label[i] == tag[i]
            kept = plain or page.good[i] or tag[i] in ("#page", "html", "body")
            flags[i] = flags[i] or path in unimportant and not kept
    gone = _inherit(page, flags)
    # Lists of links are menus.
    own = _sizes(page, gone)
    linked = _inherit(page, [t == "a" for t in tag])
    linked_sizes = _summed(page, [x if y else 0 for x, y in zip(own, linked)])
    links, sizes = _summed(page, [int(t == "a") for t in tag]), _summed(page, own)
    for i in range(1, n):
        if tag[i] in LISTS and links[i] >= LINKS and linked_sizes[i] >= LINK_SHARE * max(1, sizes[i]):
            gone[i] = True
    return _inherit(page, gone)


def _places(page: Page, gone: list[bool]) -> Iterator[list[bool]]:
    """Which elements may hold the article, the best places first."""
    n = len(page.tag)
    sizes = _summed(page, _sizes(page, gone))
    for name in ("article", "main"):
        yield _inherit(page, [page.tag[i] == name and not gone[i] for i in range(n)])
    named = [page.good[i] and not gone[i] for i in range(n)]
    if any(named[i] and 3 * sizes[i] >= sizes[0] for i in range(n)):
        yield _inherit(page, named)
    yield [True] * n


def main_text(source: str | None, unimportant: frozenset[int] = frozenset()) -> str:
    """The article of a page: its blocks, joined by empty lines. ``unimportant``: paths of
    branches that the site's style tree gives little importance."""
    if not source:
        return ""
    page = Page(source)
    gone = _removed(page, unimportant)
    for inside in _places(page, gone):
        blocks: dict[int, list[str]] = {}
        for number, element, text in page.texts:
            if inside[element] and not gone[element]:
                blocks.setdefault(number, []).append(text)
        lines = (" ".join("".join(parts).split()) for parts in blocks.values())
        if text := "\n\n".join(line for line in lines if line):
            return text
    return ""


def _tree_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a page adds to its site's tree: ``site``, ``page`` (a hash of its source), ``node``,
    ``style`` (true for the styles of the node, false for a text in it), ``item`` (a hash of either),
    and ``up`` for styles, the paths from the node to the top."""
    names = ["site", "page", "node", "style", "item", "up"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.list_(pa.int64())]
    schema = pa.schema(list(zip(names, kinds)))
    digest = xxhash.xxh64_intdigest
    for batch in batches:
        rows: dict[str, list] = {c: [] for c in names}
        for site, source in zip(batch.column(0).to_pylist(), batch.column(1)):
            source = source.as_py()
            if not source:
                continue
            page = Page(source)
            paths, above = page.paths()
            own: dict[int, list[str]] = {}
            for _, element, text in page.texts:
                own.setdefault(element, []).append(text)
            found, styles, first = set(), {}, {}
            children: dict[int, list[str]] = {}
            for i in range(1, len(page.tag)):
                first.setdefault(paths[i], i)
                children.setdefault(page.parent[i], []).append(page.label[i])
            for i in range(1, len(page.tag)):
                styles.setdefault(paths[i], []).append(",".join(children.get(i, ())))
                text = " ".join("".join(own.get(i, ())).split())
                if text:
                    found.add((paths[i], digest(text) >> 1))
            number = digest(source) >> 1
            for node, parts in styles.items():
                up, element = [], first[node]
                while element > 0:
                    up.append(paths[element])
                    element = above[element]
                for c, v in zip(names, (site, number, node, True, digest(";".join(parts)) >> 1, up)):
                    rows[c].append(v)
            for node, item in found:
                for c, v in zip(names, (site, number, node, False, item, None)):
                    rows[c].append(v)
        yield pa.RecordBatch.from_arrays([pa.array(rows[c], t) for c, t in zip(names, kinds)], schema=schema)


def site_of(url: Column) -> Column:
    """The host of a URL in lower case; empty where there is none."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.lower(host)


def style_trees(
    pages: DataFrame, url_col: str = "url", html_col: str = "html", damp: float = DAMP
) -> DataFrame:
    """The merged tree of each site: ``site`` (a hash of the host), ``node``, ``pages`` (different
    pages that have it), ``presentation``, ``content`` and ``importance``, all from 0 to 1.

    Copies of a page count once. Null and empty pages add nothing; an empty table gives no rows.
    """
    asked = pages.select(
        F.xxhash64(site_of(F.col(url_col))).alias("site"), F.col(html_col).cast("string").alias("html")
    )
    rows = map_arrow(
        asked, _tree_rows, "site long, page long, node long, style boolean, item long, up array<long>"
    )
    item = ["site", "node", "style", "item"]
    # Copies fall together first, with the page in the key; then pages are counted.
    once = rows.groupBy(*item, "page").agg(F.first("up").alias("up"))
    counted = once.groupBy(*item).agg(F.count(F.lit(1)).alias("df"), F.first("up").alias("up"))
    counted = stored(counted, "style-tree")
    style, text = F.col("style"), ~F.col("style")
    df = F.col("df").cast("double")
    nodes = counted.groupBy("site", "node").agg(
        F.sum(F.when(style, F.col("df"))).alias("pages"),
        F.sum(F.when(style, df * F.log(df))).alias("style_log"),
        # Every occurrence of a text counts, so that what all pages share weighs as it shows.
        F.sum(F.when(text, df)).alias("texts"),
        F.sum(F.when(text, df * F.log(df))).alias("text_log"),
        F.first(F.when(style, F.col("up")), ignorenulls=True).alias("up"),
    )
    base = F.log(F.col("pages").cast("double"))
    many = F.col("pages") > 1
    # -sum p log p with p = df / pages; a text's entropy is log(df) / log(pages).
    presentation = F.when(many, 1 - F.col("style_log") / F.col("pages") / base).otherwise(1.0)
    entropy = F.when(many, F.least(F.col("text_log") / base, F.col("texts"))).otherwise(0.0)
    nodes = nodes.select(
        "site",
        "node",
        "pages",
        F.round(F.greatest(F.lit(0.0), presentation), 9).alias("presentation"),
        F.coalesce("texts", F.lit(0.0)).alias("texts"),
        F.coalesce(entropy, F.lit(0.0)).alias("shared"),
        "up",
    )
    nodes = stored(nodes, "style-nodes")
    # A node's texts and entropies count for all nodes above it.
    branch = nodes.select("site", F.explode("up").alias("node"), "texts", "shared")
    branch = branch.groupBy("site", "node").agg(
        F.sum("texts").alias("all_texts"), F.sum("shared").alias("all_shared")
    )
    kinds = nodes.where(F.size("up") > 1).select("site", F.element_at("up", 2).alias("node"))
    kinds = kinds.groupBy("site", "node").agg(F.count(F.lit(1)).alias("kinds"))
    joined = nodes.join(branch, ["site", "node"], "left").join(kinds, ["site", "node"], "left")
    content = F.when(F.col("all_texts") > 0, 1 - F.col("all_shared") / F.col("all_texts")).otherwise(1.0)
    content = F.round(F.greatest(F.lit(0.0), content), 9)
    weight = F.pow(F.lit(damp), F.coalesce("kinds", F.lit(0)))
    return joined.select("site", "node", "pages", "presentation", content.alias("content"), weight.alias("weight")).select(
        "site",
        "node",
        "pages",
        "presentation",
        "content",
        ((1 - F.col("weight")) * F.col("presentation") + F.col("weight") * F.col("content")).alias("importance"),
    )


def extract_main_text(
    pages: DataFrame,
    url_col: str = "url",
    html_col: str = "html",
    threshold: float = THRESHOLD,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """``pages`` without the html, with ``main_text``: the article's blocks in page order, joined by
    empty lines; white space within a block is one space, character references are decoded.

    Branches below ``threshold`` of a site with at least ``min_pages`` different pages that have them
    are removed, as are those that the markup declares to be no article. An element named article or
    main, and plain elements inside one, are never removed for their importance. If a page has
    articles, the text is theirs; else that of its main element; else that of what class or id
    call its content, if one such element holds a third of the text; else all that is left.

    Null and empty pages give an empty text; pages without a URL are one site. Repeated rows are
    extracted each. An empty table gives no rows. Other columns are kept, whatever their names but
    ``main_text``, which is replaced.
    """
    trees = style_trees(pages, url_col, html_col)
    low = trees.where((F.col("pages") >= min_pages) & (F.col("importance") < threshold))
    # Nodes of templates: a site has as many as its templates have branches.
    low = low.groupBy("site").agg(F.collect_list("node").alias("low"))
    low = stored(low, "low-branches")
    # The other columns travel in one of their own, so that no name of theirs can clash.
    kept = F.struct(*(F.col(f"`{c}`") for c in pages.columns if c not in (html_col, "main_text")))
    asked = pages.select(
        kept.alias("row"),
        F.xxhash64(site_of(F.col(url_col))).alias("site"),
        F.col(html_col).cast("string").alias("html"),
    ).join(low, "site", "left")
    asked = asked.select("row", "html", "low")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                main_text(source.as_py(), frozenset(low.as_py() or ()))
                for source, low in zip(batch.column(1), batch.column(2))
            ]
            columns = [batch.column(0), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "main_text"])

    found = asked.mapInArrow(run, StructType([asked.schema["row"], StructField("main_text", StringType())]))
    return found.select("row.*", "main_text")
