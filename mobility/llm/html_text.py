"""Main-text extraction: gradient-boosted trees over DOM nodes, decoded as a tree.

A page is parsed into nodes: elements (inline ones only if their attributes
say something) and the runs of text in them. Each node has features of its subtree (text, tags, share of
link text, share of the page), its tag, the words of its attributes and those of its
ancestors, its depth and its siblings. Boosted trees give each node the log-odds of
holding main text. Of all labellings in which nothing below a dropped node is
kept, the likeliest is taken (dynamic programming from the leaves), so no
node contradicts its ancestors. The text runs kept are the result.

Training. ``sample_pages`` different pages, about, are chosen by a hash of the id and the page, so one id on many rows
brings no more than its share, and pages of over ``SAMPLE_NODES`` nodes are passed over: what the
driver fits on is bounded. Pages that mark
their article (``article``, ``main``, role main) label themselves: main text is what lies in it
and in nothing that tag or attributes call something else. Each such page is learned
three times: as it is; without tags and attribute words, so that the trees also
learn from shape alone; and as if all of it lay in an article, so that they
learn what doesn't belong there. A page set without any marked article gets a model of one
step: drop what tag or attributes call something else.

Text: character references decoded; white space in a block (between the
borders of block elements and line breaks) becomes one space; blocks are
trimmed and joined by ``\\n`` in page order. Comments, scripts, styles and markup never count.

Defined cases: null and empty pages, an empty table's none, and pages without main text give ``""``; a very long page is
read whole, in time linear in its length; ties (a node worth nothing either way) are dropped; broken
markup is read as browsers do in the main (open paragraphs and list items close,
stray end tags are ignored, a tag cut off at the end is dropped); repeated rows give repeated rows; other
columns pass through, and columns named like an output give way to it.
"""
from __future__ import annotations

import html as _html
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mobility.llm.common import binary_values, slices, with_replaced

SAMPLE_PAGES = 300
#: Nodes of a page that training learns from; larger pages of the sample are passed over.
SAMPLE_NODES = 20_000
TREES = 30
DEPTH = 3
RATE = 0.3
BINS = 32
PIECE_BYTES = 4 << 20

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|"
    r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
_OPEN_END = re.compile(r"<!--|<!\[CDATA\[")
_CUT_OFF = re.compile(r"<[/a-zA-Z!?][^>]*\Z")
_UNENDED = re.compile(r"(?:<!--|<!\[CDATA\[).*", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
#: Elements that begin and end a block (and line breaks); all others, unknown names too, lie within a line.
BLOCK = frozenset(
    "address article aside blockquote body br caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frame frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section summary table tbody td tfoot th thead title tr ul".split())
#: Elements of a line that a slash before the bracket doesn't end.
PHRASING = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul li".split())
#: What an opening tag closes, and what the search for it doesn't cross.
CLOSES = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])), "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr"]), frozenset(["table", "tbody", "thead", "tfoot"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr"])), "th": (frozenset(["td", "th"]), frozenset(["tr"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
}
# Words that pages use for what isn't the article, and for what is.
OTHER_TAGS = frozenset(
    "nav header footer aside form menu dialog noscript button select fieldset template svg object audio video "
    "canvas head".split())
OTHER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent "
    "cookie cookies copyright disclaimer disqus footer form gdpr header login masthead menu modal nav navbar navigation "
    "feedback newsletter notice notification outbrain pager pagination popup promo promotion promoted recommended related "
    "reply replies respond response search share sharing shared sidebar signup skip social sponsor sponsored sponsors subscribe "
    "subscription taboola toolbar tracking warning widget alert hidden".split())
MAIN_TAGS = frozenset(["article", "main"])
MAIN_WORDS = frozenset("article blog body content entry hentry main maincontent page post story text".split())
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])

N_FEATURES = 15


def attribute_cues(attributes: str) -> tuple[int, int]:
    """How many attribute words speak against, and for, main text."""
    other = main = 0
    for name, value in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name in ("class", "id", "role"):
            for w in _WORD.findall(value):
                w = w.lower()
                other += w in OTHER_WORDS or w.removesuffix("s") in OTHER_WORDS
                main += w in MAIN_WORDS
        elif name == "hidden" or name == "aria-hidden" and "true" in value or name == "style" and "none" in value and "display" in value:
            other += 1
    return other, main


class Page:
    """Nodes of one page, parents before children; text runs are leaves."""

    def __init__(self, text: str):
        self.parent: list[int] = [-1]
        self.tag: list[str] = ["#page"]
        self.other: list[int] = [0]
        self.main: list[int] = [0]
        self.runs: dict[int, list[str]] = {}  # by leaf: its pieces of text
        self.linked: dict[int, int] = {}
        self.block: dict[int, int] = {}
        self._read(text)

    def _node(self, parent: int, tag: str, other: int, main: int) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.other.append(other)
        self.main.append(main)
        return len(self.parent) - 1

    def _read(self, text: str) -> None:
        stack: list[tuple[str, int]] = [("#page", 0)]  # open tags with the node they are in
        open_: dict[str, int] = {}
        block = leaf = links = 0  # the current block's number, the open leaf (0: none)
        at = 0
        cues: dict[str, tuple[int, int]] = {}

        def say(piece: str) -> None:
            nonlocal leaf
            if not piece or (not leaf and piece.isspace()):
                return
            node = stack[-1][1]
            if not leaf or self.parent[leaf] != node:
                leaf = self._node(node, "#text", 0, 0)
                self.runs[leaf], self.linked[leaf], self.block[leaf] = [], 0, block
            self.runs[leaf].append(piece)
            if links:
                self.linked[leaf] += len(piece)

        def pop(n: int) -> bool:
            """Close open tags down to ``n``; whether a block ends."""
            nonlocal links
            ended = False
            while len(stack) > n:
                name, _ = stack.pop()
                open_[name] -= 1
                links -= name == "a"
                ended |= name in BLOCK
            return ended

        def close(names: frozenset, barrier: frozenset) -> bool:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in names:
                    return pop(k)
                if stack[k][0] in barrier:
                    break
            return False

        # No tag begins after the last bracket, so no search for its end runs through the text in vain.
        last = text.rfind(">") + 1
        for m in _TAG.finditer(text, 0, last):
            if m.start() < at:
                continue  # inside an element of raw text
            if m.start() > at:
                say(text[at: m.start()])
            at = m.end()
            name = (m[2] or m[5] or "").lower()
            if not name:
                if at == last and _OPEN_END.match(m[0]) and not m[0].endswith(("-->", "--!>", "]]>")):
                    at = len(text)  # a comment that nothing ends
                continue
            if m[1] or m[4]:
                if open_.get(name):
                    for k in range(len(stack) - 1, 0, -1):
                        if stack[k][0] == name:
                            if pop(k):
                                block, leaf = block + 1, 0
                            break
                elif name in BLOCK:
                    block, leaf = block + 1, 0
                continue
            if name in RAW:
                end = re.compile(rf"</{name}[\s/>]", re.I).search(text, at)
                at = end.start() if end else len(text)
                open_[name] = open_.get(name, 0) + 1
                stack.append((name, stack[-1][1]))
                continue
            if name in BLOCK:
                block, leaf = block + 1, 0
                if name in CLOSES_P and open_.get("p"):
                    close(frozenset(["p"]), frozenset(["td", "th", "button", "table"]))
                if name in CLOSES and any(open_.get(x) for x in CLOSES[name][0]):
                    close(*CLOSES[name])
            if name in VOID:
                continue
            attributes = m[3] or m[6] or ""
            if attributes:
                if attributes not in cues:
                    cues[attributes] = attribute_cues(attributes)
                other, main = cues[attributes]
            else:
                other = main = 0
            other += name in OTHER_TAGS
            main += name in MAIN_TAGS
            node = stack[-1][1]
            if name in BLOCK or other:
                node = self._node(node, name, other, main)
            if attributes.endswith("/") and name not in CLOSES_P and name not in PHRASING:
                continue
            stack.append((name, node))
            open_[name] = open_.get(name, 0) + 1
            links += name == "a"
        tail = _CUT_OFF.sub("", _UNENDED.sub("", text[at:]))
        say(tail)

    def texts(self, kept: np.ndarray) -> str:
        """The kept leaves' text, block by block."""
        blocks: dict[int, list[str]] = {}
        for leaf, pieces in self.runs.items():
            if kept[leaf]:
                blocks.setdefault(self.block[leaf], []).extend(pieces)
        out = [" ".join(_html.unescape("".join(p)).split()) for _, p in sorted(blocks.items())]
        return "\n".join(t for t in out if t)

    def labels(self) -> np.ndarray | None:
        """Whether each node holds main text, if the page marks its article."""
        n = len(self.parent)
        inside, out, marked = [False] * n, [False] * n, False
        for i in range(1, n):
            p = self.parent[i]
            is_main = self.tag[i] in MAIN_TAGS
            marked |= is_main
            inside[i] = (inside[p] or is_main) and not self.other[i]
        if not marked:
            return None
        for i in range(n - 1, 0, -1):
            if inside[i] and self.tag[i] == "#text":
                out[i] = True
            if out[i]:
                out[self.parent[i]] = True
        return np.array(out)

    def features(self, blind: bool = False) -> np.ndarray:
        """A row of features per node. ``blind``: as if without tags and attributes."""
        n = len(self.parent)
        parent, tag = self.parent, self.tag
        text, link, tags, leaves = [0] * n, [0] * n, [0] * n, [0] * n
        depth, children = [0] * n, [0] * n
        other_up, main_up = [0] * n, [0] * n
        other = [0] * n if blind else self.other
        main = [0] * n if blind else self.main
        for i in range(1, n):
            p = parent[i]
            depth[i] = depth[p] + 1
            children[p] += 1
            other_up[i], main_up[i] = other_up[p] + other[i], main_up[p] + main[i]
            if i in self.runs:
                text[i] = sum(map(len, self.runs[i]))
                link[i], leaves[i] = self.linked[i], 1
            else:
                tags[i] = 1
        for i in range(n - 1, 0, -1):
            p = parent[i]
            text[p] += text[i]
            link[p] += link[i]
            tags[p] += tags[i]
            leaves[p] += leaves[i]
        x = np.zeros((n, N_FEATURES), dtype=np.float32)
        par = np.maximum(np.array(parent), 0)
        text_, tags_ = np.array(text, dtype=np.float32), np.array(tags, dtype=np.float32)
        kids = np.maximum(np.array(children, dtype=np.float32)[par], 1)
        x[:, 0], x[:, 1], x[:, 2], x[:, 3] = other, main, other_up, main_up
        x[:, 4] = depth
        x[:, 5] = np.log1p(text_)
        x[:, 6] = np.array(link) / np.maximum(text_, 1)
        x[:, 7] = np.log1p(text_ / (tags_ + 1))
        x[:, 8] = text_ / max(text[0], 1)
        x[:, 9] = np.log1p(kids)
        x[:, 10] = text_ * kids / np.maximum(text_[par], 1)  # against the mean of the siblings
        x[:, 11] = np.log1p(text_[par])
        x[:, 12] = np.log1p(text_[par] / kids)
        x[:, 13] = np.log1p(leaves)
        x[:, 14] = [1 if t == "#text" else 0 if blind else _KIND.get(t, 0) for t in tag]
        return x


_KIND = {"p": 2, **dict.fromkeys(HEADINGS, 3), "li": 4, "dt": 4, "dd": 4, "td": 5, "th": 5, "tr": 5, "table": 5,
         "ul": 6, "ol": 6, "dl": 6, "div": 7, "section": 7, "blockquote": 8, "pre": 8}


class BoostedTrees:
    """Logistic gradient boosting on binned features: full binary trees of a fixed depth."""

    def __init__(self, base: float, trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.base, self.trees = base, trees  # (feature, threshold) by inner node, value by leaf

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, n_trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> BoostedTrees:
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
        share = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
        score = np.full(len(y), np.log(share / (1 - share)))
        trees = []
        for _ in range(n_trees):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, p * (1 - p)
            feature = np.zeros(2**depth - 1, dtype=np.int64)
            threshold = np.full(2**depth - 1, np.inf)
            place = np.zeros(len(y), dtype=np.int64)
            for level in range(depth):
                for node in range(2**level - 1, 2 ** (level + 1) - 1):
                    rows = np.flatnonzero(place == node)
                    found = cls._split(binned[rows], g[rows], h[rows], cuts)
                    if found is not None:
                        feature[node], threshold[node] = found[0], cuts[found[0]][found[1]]
                place = 2 * place + 1 + (x[np.arange(len(y)), feature[place]] > threshold[place])
            leaf = place - (2**depth - 1)
            value = rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + 1.0)
            trees.append((feature, threshold, value))
            score += value[leaf]
        return cls(float(np.log(share / (1 - share))), trees)

    @staticmethod
    def _split(binned: np.ndarray, g: np.ndarray, h: np.ndarray, cuts: list[np.ndarray]) -> tuple[int, int] | None:
        best, found = 1e-6, None
        if len(g) < 2:
            return None
        total_g, total_h = g.sum(), h.sum()
        for f, c in enumerate(cuts):
            if not len(c):
                continue
            gl = np.cumsum(np.bincount(binned[:, f], g, len(c) + 1))[:-1]
            hl = np.cumsum(np.bincount(binned[:, f], h, len(c) + 1))[:-1]
            gain = gl**2 / (hl + 1) + (total_g - gl) ** 2 / (total_h - hl + 1) - total_g**2 / (total_h + 1)
            k = int(gain.argmax())
            if gain[k] > best:
                best, found = gain[k], (f, k)
        return found

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in self.trees:
            place = np.zeros(len(x), dtype=np.int64)
            for _ in range(int(np.log2(len(value)))):
                place = 2 * place + 1 + (x[rows, feature[place]] > threshold[place])
            out += value[place - len(feature)]
        return out


#: One step on "words of the node or its ancestors speak against main text".
UNTRAINED = BoostedTrees(0.0, [(np.array([2]), np.array([0.5]), np.array([2.0, -2.0]))])


def decode(parent: list[int], log_odds: np.ndarray) -> np.ndarray:
    """The likeliest labelling in which all below a dropped node is dropped.

    A kept node gains its log-odds over being dropped; a subtree is worth keeping if
    the best choice in it gains more than nothing.
    """
    gain = log_odds.tolist()
    for i in range(len(parent) - 1, 0, -1):
        if gain[i] > 0:
            gain[parent[i]] += gain[i]
    kept = [True] * len(parent)
    for i in range(1, len(parent)):
        kept[i] = kept[parent[i]] and gain[i] > 0
    return np.array(kept)


def training_rows(page: Page) -> np.ndarray:
    """A page's features as it is, without tags and attribute words, and as if
    all of it lay in an article."""
    plain = page.features()
    within = plain.copy()
    within[:, 3] = np.maximum(within[:, 3], 1)
    return np.concatenate([plain, page.features(blind=True), within])


def train(pages: DataFrame, id_col: str = "page_id", html: str = "html", sample_pages: int = SAMPLE_PAGES) -> BoostedTrees:
    """Fit the trees on a sample of about ``sample_pages`` pages."""
    n = pages.count()
    if not n:
        return UNTRAINED
    limit = min(1 << 30, -(-sample_pages * (1 << 30) // n))
    page = F.col(f"`{html}`").cast("string")
    drawn = pages.select(page.alias("h"), F.xxhash64(F.col(f"`{id_col}`"), F.lit(3), page).alias("at"))
    sample = drawn.where(F.pmod("at", F.lit(1 << 30)) < limit).dropDuplicates(["at"]).select("h")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h in binary_values(batch.column(0)):
                page = Page((h or b"").decode("utf-8", "replace"))
                y = page.labels() if len(page.parent) <= SAMPLE_NODES else None
                if y is not None:
                    x = training_rows(page)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x.astype("<f4").tobytes()]), pa.array([np.tile(y, len(x) // len(y)).astype(np.uint8).tobytes()])],
                        names=["x", "y"])

    rows = sorted((bytes(r["x"]), bytes(r["y"])) for r in sample.mapInArrow(run, "x binary, y binary").collect())
    if not rows:
        return UNTRAINED
    x = np.frombuffer(b"".join(a for a, _ in rows), dtype="<f4").reshape(-1, N_FEATURES)
    y = np.frombuffer(b"".join(b for _, b in rows), dtype=np.uint8).astype(float)
    return BoostedTrees.fit(x, y)


def main_text(texts: list[bytes | None], model: BoostedTrees) -> list[str]:
    """The main text of each page."""
    pages = [Page((t or b"").decode("utf-8", "replace")) for t in texts]
    if not pages:
        return []
    odds = model.log_odds(np.concatenate([p.features() for p in pages]))
    out, at = [], 0
    for p in pages:
        n = len(p.parent)
        out.append(p.texts(decode(p.parent, odds[at: at + n])))
        at += n
    return out


def extract(pages: DataFrame, model: BoostedTrees, html: str = "html", out: str = "text", n_chars: str = "n_chars",
            keep: list[str] | None = None) -> DataFrame:
    """``pages`` (or its columns ``keep``) with the main text and its length in code points."""
    shared = pages.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in (keep if keep is not None else with_replaced(pages, out, n_chars).columns)]
    src = pages.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{html}`").cast("string").alias("__html"))
    schema = T.StructType([*src.schema.fields[:-1], T.StructField(out, T.StringType(), False), T.StructField(n_chars, T.LongType(), False)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, PIECE_BYTES, "__html"):
                texts = main_text(binary_values(batch.column(len(kept))), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[: len(kept)], pa.array(texts, type=pa.string()),
                     pa.array([len(t) for t in texts], type=pa.int64())], names=[*kept, out, n_chars])

    return src.mapInArrow(run, schema)
