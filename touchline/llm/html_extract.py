"""Main-text extraction by tag-path ratios.

A page is read once by a tolerant tag scanner. Elements that hold no main text by their tag, role, class or id are left out.
Text goes to blocks, each under a root-to-leaf path of block elements; per path, text length, punctuation and link text
are summed over all its blocks. Text and punctuation per block are smoothed over neighbouring blocks in page order and
fused, by their product with the share of text outside links, with the same ratio of the container; paths above a
threshold (a fraction of the mean over all text) are content. The element that holds the content is found from these
paths, and the text is its blocks of content paths, in page order; no tag is content by its name.

Defined cases: null or empty html, or a page without content, gives an empty text; unclosed and misnested tags are
closed as browsers do for blocks; repeated rows are extracted each; an empty table gives an empty result; memory is
linear in one page, whatever its nesting.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from touchline.llm.base import map_batches, table

#: Fixed values of HTML: elements whose text is raw, that end a block, that have no end tag.
RAW = frozenset("script style noscript template textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "html head body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup "
    "hr li main menu nav ol p pre section summary table caption thead tbody tfoot tr td th ul select option button".split()
)
#: Elements and names of classes, ids or roles that hold no main text.
SKIP_TAGS = frozenset("head script style noscript template textarea title nav footer aside form iframe select option button dialog svg math object canvas audio video menu xmp noembed noframes".split())
SKIP_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner\w*|nav|navbar|navigation|menu\w*|breadcrumbs?|sidebars?|aside|footer|foot|topbar|masthead|site-header|page-header|header|cookies?|consent|gdpr|notices?|alert|"
    r"newsletter|subscribe|signup|login|popup|modal|overlay|share|sharing|social|related|recommend\w*|comments?|commentlist|disqus|respond|reply|replies|widget\w*|toolbar|pagination|pager|search|copyright|disclaimer|skip-link)(?:$|[\s_-])",
    re.I,
)
CONTAINERS = frozenset("html body div section article main table tbody tr td center".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}, "tbody": {"table"}, "tfoot": {"table"}}
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|</?([a-zA-Z][^\s/>]*+)[^>]*+>", re.S)
_NAMES = re.compile(r"""\b(class|id|role|itemprop|hidden|aria-hidden)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_PUNCT = re.compile(r"[.,;:!?¡¿…。，、！？]")
_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)[^>]*>?", re.I) for t in RAW}
#: Elements whose sums a block's path is fused with, the weight of that, and the share of the mean score that content reaches.
SECTIONS = frozenset("body div section article main aside nav header footer form center".split())
FUSE, THRESHOLD = 2 / 3, 0.12


class Page:
    """Blocks of one page: path, elements above, text pieces, link length and whether boilerplate."""

    def __init__(self, source: str):
        self.paths: dict[tuple[int, str], int] = {}
        self.tags: list[str] = ["#root"]
        self.parent: list[int] = [-1]
        self.skip: list[bool] = [False]
        self.main: list[bool] = [False]
        self.path: list[int] = [0]
        self.stack, self.links = [0], 0
        self.blocks: list[tuple[int, int, list[str], list[int]]] = []
        self.open_block: int | None = None
        self.read(source)

    def text(self, piece: str) -> None:
        if not piece:
            return
        if self.open_block is None:
            if not piece.strip():
                return
            self.open_block = len(self.blocks)
            self.blocks.append((self.path[self.stack[-1]], self.stack[-1], [], [0]))
        block = self.blocks[self.open_block]
        block[2].append(piece)
        if self.links:
            block[3][0] += len(piece)

    def start(self, tag: str, rest: str) -> None:
        if tag in ("br", "wbr"):
            self.text(" " if tag == "br" else "")
            return
        if tag in VOID:
            self.open_block = None if tag == "hr" else self.open_block
            return
        if tag not in BLOCK and tag not in SKIP_TAGS:
            self.links += tag == "a"
            return
        self.open_block = None
        tags, stack = self.tags, self.stack
        if tags[stack[-1]] == "p" and tag in BLOCK:
            stack.pop()
        if tag in CLOSES:
            for k in range(len(stack) - 1, 0, -1):
                if tags[stack[k]] in SCOPE[tag]:
                    break
                if tags[stack[k]] in CLOSES[tag]:
                    del stack[k:]
                    break
        if tag[0] == "h" and len(tag) == 2 and len(tags[stack[-1]]) == 2 and tags[stack[-1]][0] == "h" and tags[stack[-1]][1].isdigit():
            stack.pop()
        names = " ".join(f"{m[2] or m[3] or m[4] or ''}" if m[1].lower() not in ("hidden", "aria-hidden") else "" for m in _NAMES.finditer(rest)) if rest else ""
        up = stack[-1]
        main = tag in ("article", "main") or bool(re.search(r"\b(articleBody|main|article)\b", names)) and tag in CONTAINERS
        boiler = tag in SKIP_TAGS or tag == "header" and not self.inside_main(up) or bool(names and SKIP_NAME.search(names)) and tag not in ("html", "body")
        self.tags.append(tag)
        self.parent.append(up)
        self.skip.append(self.skip[up] or boiler)
        self.main.append(main and not boiler)
        self.path.append(self.paths.setdefault((self.path[up], f"{tag}.{names}" if names and tag in CONTAINERS else tag), len(self.paths) + 1))
        stack.append(len(tags) - 1)

    def inside_main(self, node: int) -> bool:
        while node > 0:
            if self.main[node]:
                return True
            node = self.parent[node]
        return False

    def end(self, tag: str) -> None:
        if tag in VOID:
            return
        if tag not in BLOCK and tag not in SKIP_TAGS:
            self.links = max(0, self.links - (tag == "a"))
            return
        self.open_block = None
        for k in range(len(self.stack) - 1, 0, -1):
            if self.tags[self.stack[k]] == tag:
                del self.stack[k:]
                self.links = 0
                return

    def read(self, source: str) -> None:
        at, n = 0, len(source)
        while at < n:
            m = _TAG.search(source, at)
            if not m:
                self.text(html.unescape(source[at:]))
                return
            if m.start() > at:
                self.text(html.unescape(source[at : m.start()]))
            at = m.end()
            name = m[2] or m[4]
            if not name:
                continue
            tag = name.lower()
            if m[1] or source[m.start() + 1] == "/":
                self.end(tag)
                continue
            self.start(tag, m[3] or "")
            if tag in RAW and not (m[3] or "").rstrip().endswith("/"):
                stop = _END[tag].search(source, at)
                at = stop.end() if stop else n
                self.end(tag)


def _smooth(values: list[float]) -> list[float]:
    """A centred (1, 2, 1) / 4 average; ends repeat."""
    n = len(values)
    return [(values[max(0, i - 1)] + 2 * values[i] + values[min(n - 1, i + 1)]) / 4 for i in range(n)]


def ratio(blocks: float, chars: float, marks: float, linked: float) -> float:
    """Text per block, raised by punctuation per block, without the share in links."""
    return chars / blocks * (1 + marks / blocks) * max(0.0, 1 - linked / chars)


def path_scores(rows: list[tuple[int, int, str, int]], container: list[int]) -> dict[int, float]:
    """The fused score of each path. rows: (path, element, text, characters in links) in page order; container: of an element.

    A path's own ratio comes from its sums, its text and its marks smoothed over the blocks beside each of its blocks. It is
    fused, as a weighted geometric mean, with the ratio of the container (article, section, division, ...) that holds the
    block, summed over all that is in it, so that a heading or a short item counts by where it stands.
    """
    sums: dict[int, list[float]] = {}
    held: dict[int, list[float]] = {}
    for path, node, text, link in rows:
        for s in (sums.setdefault(path, [0.0] * 4), held.setdefault(container[node], [0.0] * 4)):
            for k, v in enumerate((1.0, float(len(text)), float(len(_PUNCT.findall(text))), float(min(link, len(text))))):
                s[k] += v
    chars = _smooth([sums[r[0]][1] / sums[r[0]][0] for r in rows])
    marks = _smooth([sums[r[0]][2] / sums[r[0]][0] for r in rows])
    found: dict[int, list[float]] = {}
    for a, b, (path, node, _, _) in zip(chars, marks, rows, strict=True):
        own = ratio(1.0, a, b, a * sums[path][3] / sums[path][1])
        found.setdefault(path, []).append(own ** (1 - FUSE) * ratio(*held[container[node]]) ** FUSE)
    return {p: sum(v) / len(v) for p, v in found.items()}


def content_paths(rows: list[tuple[int, int, str, int]], container: list[int], threshold: float = THRESHOLD) -> set[int]:
    """Paths whose score reaches threshold times the mean over all text; if no path has a score, all paths."""
    score = path_scores(rows, container)
    if not any(score.values()):
        return set(score)
    total = sum(len(r[2]) for r in rows)
    least = threshold * sum(score[r[0]] * len(r[2]) for r in rows) / total
    return {p for p, v in score.items() if v >= least and v > 0}


def main_text(source: str | None, threshold: float = THRESHOLD) -> str:
    """The page's main text: blocks of content paths under the element that holds most of them, in page order."""
    if not source:
        return ""
    page = Page(source)
    rows = []
    for path, node, pieces, link in page.blocks:
        text = "" if page.skip[node] else " ".join("".join(pieces).split())
        if text:
            rows.append((path, node, text, link[0]))
    if not rows:
        return ""
    container: list[int] = []
    for node, tag in enumerate(page.tags):
        container.append(node if tag in SECTIONS or page.parent[node] < 0 else container[page.parent[node]])
    content = content_paths(rows, container, threshold)
    # text of content paths under each element; the parent's number is less than the child's
    held = [0] * len(page.tags)
    for path, node, text, _ in rows:
        if path in content:
            held[node] += len(text)
    for node in range(len(held) - 1, 0, -1):
        held[page.parent[node]] += held[node]
    mains = [n for n in range(len(held)) if page.main[n] and 2 * held[n] >= held[0] > 0]
    if mains:
        # the outermost, unless one within it holds as much
        root = min(mains, key=lambda n: (-held[n], -n))
    else:
        root, best = 0, {}
        for n in range(1, len(held)):
            if page.tags[n] in CONTAINERS and held[n] > held[best.get(page.parent[n], n)] - (page.parent[n] not in best):
                best[page.parent[n]] = n
        while root in best and held[best[root]] >= 0.8 * held[root] > 0:
            root = best[root]
    inside = [False] * len(held)
    inside[root] = True
    for n in range(root + 1, len(held)):
        inside[n] = inside[page.parent[n]]
    return " ".join(text for path, node, text, _ in rows if path in content and inside[node])


def extract(pages: DataFrame, keep: list[str]) -> DataFrame:
    """keep columns with text and n_chars."""

    def run(sources: pa.Array) -> dict[str, pa.Array]:
        texts = [main_text(x.as_py()) for x in sources]
        return {"_text": pa.array(texts, pa.string()), "_n": pa.array([len(t) for t in texts], pa.int64())}

    return map_batches(pages, run, "_text string, _n long", keep, ["html"]).withColumnsRenamed({"_text": "text", "_n": "n_chars"})


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"), ["page_id", "url"])
