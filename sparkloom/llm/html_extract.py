"""Main text of web pages by minimum-cut labelling.

A page becomes its blocks of text in page order. A logistic classifier over
layout features, plus the evidence of the containers that a block stands in, gives
each block its terminal capacities; blocks next to each other and blocks of one
parent are joined by smoothness edges. The minimum cut, found by max-flow, separates
content from boilerplate.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sparkloom.llm.common import batches, sample_rows

#: Elements of HTML by their kind.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style template iframe title".split())
CONTROLS = set("select datalist optgroup option".split())
BLOCKS = CONTROLS | set("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "optgroup": {"option", "optgroup"}}
SCOPES = set("article aside body div footer form header html main nav section table".split())
#: Words in class, id and role that name boilerplate or content.
BOILERPLATE_TAGS = set("nav aside footer form menu dialog".split())
BOILERPLATE = set("ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist complementary consent contentinfo cookie cookies copyright dialog discussion disqus footer gdpr login masthead menu menubar modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup privacy promo promotion recommended related reply replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split())
HEADERS = set("header hdr top".split())
CONTENT = set("article content entry main post story".split())

NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
ATTRIBUTE = re.compile(r"""[^>=]*+(?:(>)|=\s*+(["'])?)""")
BLOCK_TAG = re.compile(f"</?(?:{'|'.join(sorted(BLOCKS))})\\b", re.I)
PAIR = re.compile(r"""([^\s"'>/=][^\s>/=]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
WORD = re.compile(r"[a-z]+")

SAMPLE_PAGES = 2000
SAMPLE_BLOCKS = 50


@dataclass(frozen=True)
class Costs:
    """Log-odds that make a block's capacities: content, boilerplate: of standing in a container with such a name;
    text: bound of the classifier's. Smoothness: adjacent, sibling; apart: its share between blocks that stand in different kinds of container.

    The text weighs more than a content container and less than a boilerplate one, and a few alike neighbours more
    than the difference; so a container is evidence, and the cut decides.
    """

    content: float = 3.0
    boilerplate: float = 4.0
    text: float = 3.5
    adjacent: float = 0.8
    sibling: float = 0.8
    apart: float = 0.25


@dataclass(slots=True)
class Block:
    text: str
    linked: int
    state: int
    parent: int
    heading: bool
    listed: bool


def attributes_of(text: str) -> dict[str, str]:
    """Names (lower case) and values of a tag's attributes; of repeated names the first counts, as in browsers."""
    found: dict[str, str] = {}
    for name, value in PAIR.findall(text):
        found.setdefault(name.lower(), html_lib.unescape(value[1:-1] if value[:1] in ("'", '"') and value[-1:] == value[:1] and len(value) > 1 else value))
    return found


def _hidden(of: dict[str, str]) -> bool:
    return "hidden" in of or of.get("aria-hidden", "").strip().lower() == "true" or bool(NO_DISPLAY.search(of.get("style", "")))


def _state(tag: str, attributes: str, state: int) -> int:
    """1 inside content, -1 inside boilerplate, 0 unknown; boilerplate holds for all that it contains."""
    if state < 0 or tag in BOILERPLATE_TAGS or tag in CONTROLS:
        return -1
    of = attributes_of(attributes) if attributes and not attributes.isspace() else {}
    if _hidden(of):
        return -1
    names = {w for n in ("class", "id", "role") if n in of for w in WORD.findall(of[n].lower())}
    if tag in ("html", "body"):
        return state
    bad, good = bool(names & BOILERPLATE), bool(names & CONTENT)
    if tag == "header" or names & HEADERS and not good:
        return state if state > 0 else -1
    if tag in ("article", "main"):
        return -1 if bad and names & {"comment", "comments", "reply"} else 1
    if bad != good:
        return -1 if bad else 1
    return state


class _Open:
    """The open elements. Counts by tag, of all and of each scope, tell whether an element is open without a walk."""

    def __init__(self):
        self.tags, self.states, self.serials, self.blocks, self.items = [""], [0], [0], [("", 0)], [False]
        self.all: Counter = Counter()
        self.scopes: list[Counter] = [Counter()]
        self.serial = 0

    def push(self, tag: str, attributes: str) -> None:
        self.serial += 1
        self.blocks.append((tag, self.serials[-1]) if tag in BLOCKS else self.blocks[-1])
        self.states.append(_state(tag, attributes, self.states[-1]))
        self.items.append(self.items[-1] or tag == "li")
        self.tags.append(tag)
        self.serials.append(self.serial)
        self.all[tag] += 1
        self.scopes[-1][tag] += 1
        if tag in SCOPES:
            self.scopes.append(Counter())

    def close(self, names: set[str], everywhere: bool) -> None:
        """Closes the innermost open element of these names, and all in it; unless everywhere, not beyond the scope."""
        counts = self.all if everywhere else self.scopes[-1]
        if not any(counts[n] for n in names):
            return
        while True:
            tag = self.tags.pop()
            for kept in (self.states, self.serials, self.blocks, self.items):
                kept.pop()
            if tag in SCOPES:
                self.scopes.pop()
            self.all[tag] -= 1
            self.scopes[-1][tag] -= 1
            if tag in names:
                return


class _Tags:
    """Where tags and raw text end in a page. Searches that failed once are not repeated, so all of them take linear time."""

    def __init__(self, page: str):
        self.page, self.quoted, self.missing = page, True, set()

    def find(self, what: str, at: int) -> int:
        """As str.find(); -1 at once where it failed before, as places only grow."""
        if what in self.missing:
            return -1
        found = self.page.find(what, at)
        if found < 0:
            self.missing.add(what)
        return found

    def end(self, at: int) -> int:
        """Past the > of a tag whose name ends before ``at``, or -1. A > inside a quoted value is none, unless then the tag never ends."""
        start = at
        while self.quoted:
            m = ATTRIBUTE.match(self.page, at)
            if not m:
                self.quoted = False
            elif m[1]:
                return m.end()
            else:
                at = m.end()
                quote = self.find(m[2], at) if m[2] else -1
                at = quote + 1 if quote >= 0 else at
        return self.find(">", start) + 1 or -1

    def past_raw(self, tag: str, at: int) -> int:
        """Past the end tag of raw text. Without one, a title ends at the next tag and others where a block begins."""
        if tag not in self.missing:
            m = re.compile(f"</{tag}\\b", re.I).search(self.page, at)
            if m:
                return self.end(m.end()) if self.find(">", m.end()) >= 0 else len(self.page)
            self.missing.add(tag)
        if tag == "title":
            return self.find("<", at) if self.find("<", at) >= 0 else len(self.page)
        m = BLOCK_TAG.search(self.page, at)
        return m.start() if m else len(self.page)


def blocks_of(page: str) -> list[Block]:
    """Blocks with text, in page order, in time linear in the page. Character references are decoded, white space is one space.

    A < that begins no tag, comment or declaration is text. Only scripts, styles, templates, frames and titles lose their
    content; what other elements hold is text of the page.
    """
    found: list[Block] = []
    open_, tags = _Open(), _Tags(page)
    pieces: list[str] = []
    linked = at = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(pieces).split())
        if text:
            own, parent = open_.blocks[-1]
            found.append(Block(text, min(linked, len(text)), open_.states[-1], parent, own[:1] == "h" and own[1:].isdigit(), open_.items[-1]))
        pieces.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            pieces.append(html_lib.unescape(text))
            linked += len(pieces[-1]) if open_.all["a"] else 0

    while (lt := page.find("<", at)) >= 0:
        add(page[at:lt])
        m = NAME.match(page, lt)
        if not m:
            end = -1
            if page.startswith("<!--", lt):
                end = tags.find("-->", lt + 2)
                end = end + 3 if end >= 0 else -1
            if end < 0 and page[lt + 1 : lt + 2] in ("!", "?", "/"):
                end = tags.find(">", lt) + 1 or -1
            if end < 0:
                add("<")
            at = end if end >= 0 else lt + 1
            continue
        end = tags.end(m.end())
        if end < 0:  # no > any more: the rest is text
            add(page[lt:])
            at = len(page)
            break
        tag, attributes, at = m[1].lower(), page[m.end() : end - 1], end
        if page[lt + 1] == "/":
            if tag in BLOCKS:
                flush()
            open_.close({tag}, tag in BLOCKS)
            continue
        if tag in RAW:
            at = tags.past_raw(tag, at)
            pieces.append(" ")
            continue
        if tag in BLOCKS:
            flush()
            if tag not in CONTROLS:
                open_.close({"select", "datalist"}, False)
            open_.close({"p"}, False)
            open_.close(CLOSES.get(tag, set()), False)
        if tag in VOID:
            pieces.append("" if tag == "wbr" else " ")
        elif tag in BLOCKS or not attributes.endswith("/"):
            open_.push(tag, attributes)
    add(page[at:])
    flush()
    return found


def features(blocks: list[Block]) -> np.ndarray:
    """Layout features of each block: length, links, punctuation, kind of element, neighbours' length."""
    if not blocks:
        return np.zeros((0, 8))
    words = np.log1p([b.text.count(" ") + 1 for b in blocks])
    around = np.r_[words[:1], words, words[-1:]]
    rows = [
        np.ones(len(blocks)),
        words,
        [b.linked / len(b.text) for b in blocks],
        [b.text[-1] in ".!?…:;\"'”" for b in blocks],
        [sum(map(b.text.count, ".,;")) / (b.text.count(" ") + 1) for b in blocks],
        [b.heading for b in blocks],
        [b.listed for b in blocks],
        (around[:-2] + around[2:]) / 2,
    ]
    return np.array(rows, float).T


def fit(rows: np.ndarray, labels: np.ndarray, ridge: float = 1.0, rounds: int = 12) -> np.ndarray:
    """Logistic regression by Newton steps, classes weighted alike; zeros unless both classes are there."""
    weights = np.zeros(rows.shape[1])
    if len(set(labels.tolist())) < 2:
        return weights
    share = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (share * (labels - p)) - ridge * weights
        bend = (rows * (share * p * (1 - p))[:, None]).T @ rows + ridge * np.eye(rows.shape[1])
        weights = weights + np.linalg.solve(bend, slope)
    return weights


def min_cut(content: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels (True: content) of the minimum cut.

    content: log-odds; positive ones are capacities from the source, negative ones to
    the sink. edges: both ways. A block whose own capacity is at least that of all its open edges has its label; its
    edges become capacities of its neighbours. Max-flow labels the rest.
    """
    score = [round(c * 1000) for c in content]
    beside: list[list[tuple[int, int]]] = [[] for _ in score]
    for a, b, w in edges:
        beside[a].append((b, round(w * 1000)))
        beside[b].append((a, round(w * 1000)))
    loose = [sum(w for _, w in own) for own in beside]
    label: list[bool | None] = [None] * len(score)
    queue = deque(range(len(score)))
    while queue:
        i = queue.popleft()
        if label[i] is None and abs(score[i]) >= loose[i] and (score[i] or not loose[i]):
            label[i] = score[i] > 0
            for j, w in beside[i]:
                if label[j] is None:
                    score[j] += w if label[i] else -w
                    loose[j] -= w
                    queue.append(j)
    rest = [i for i, x in enumerate(label) if x is None]
    at = {i: k for k, i in enumerate(rest)}
    inner = [(at[a], at[b], w) for a, b, w in edges if a in at and b in at]
    for i, kept in zip(rest, _max_flow([score[i] / 1000 for i in rest], inner), strict=True):
        label[i] = kept
    return label


def _max_flow(content: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels by max-flow with level graphs and blocking flows."""
    excess = [round(c * 1000) for c in content]
    n = len(excess)
    out: list[list[int]] = [[] for _ in range(n)]
    to: list[int] = []
    room: list[int] = []
    for a, b, w in edges:
        out[a].append(len(to))
        to.append(b)
        out[b].append(len(to))
        to.append(a)
        room += [round(w * 1000)] * 2
    while True:
        level = [-1] * n
        queue = deque(i for i in range(n) if excess[i] > 0)
        for i in queue:
            level[i] = 0
        reached = False
        while queue:
            i = queue.popleft()
            if excess[i] < 0:
                reached = True
                continue
            for e in out[i]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[i] + 1
                    queue.append(to[e])
        if not reached:
            return [x >= 0 for x in level]
        turn = [0] * n
        for root in range(n):
            path: list[int] = []
            i = root
            while excess[root] > 0:
                if excess[i] < 0:
                    flow = min(excess[root], -excess[i], *(room[e] for e in path))
                    excess[root] -= flow
                    excess[i] += flow
                    for e in path:
                        room[e] -= flow
                        room[e ^ 1] += flow
                    path, i = [], root
                    continue
                while turn[i] < len(out[i]):
                    e = out[i][turn[i]]
                    if room[e] and level[to[e]] == level[i] + 1:
                        break
                    turn[i] += 1
                if turn[i] < len(out[i]):
                    path.append(out[i][turn[i]])
                    i = to[path[-1]]
                elif path:
                    i = to[path.pop() ^ 1]
                    turn[i] += 1
                else:
                    break


def graph(blocks: list[Block], weights: np.ndarray, costs: Costs = Costs()) -> tuple[list[float], list[tuple[int, int, float]]]:
    """Log-odds of each block and the smoothness edges: between neighbours, and between a parent's neighbouring blocks."""
    state = np.array([b.state for b in blocks])
    score = np.clip(features(blocks) @ weights, -costs.text, costs.text) + np.select([state > 0, state < 0], [costs.content, -costs.boilerplate], 0.0)
    smooth = lambda i, j, w: (i, j, w if blocks[i].state == blocks[j].state else w * costs.apart)
    edges = [smooth(i, i + 1, costs.adjacent) for i in range(len(blocks) - 1)]
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if b.parent in last:
            edges.append(smooth(last[b.parent], i, costs.sibling))
        last[b.parent] = i
    return score.tolist(), edges


def extract(page: str | None, weights: np.ndarray, costs: Costs = Costs()) -> str:
    """Main text of one page, a line per block; '' for null or without content."""
    blocks = blocks_of(page) if page else []
    if not blocks:
        return ""
    score, edges = graph(blocks, weights, costs)
    return "\n".join(b.text for b, kept in zip(blocks, min_cut(score, edges), strict=True) if kept)


def train(pages: DataFrame, html_col: str = "html", sample_pages: int = SAMPLE_PAGES) -> np.ndarray:
    """Weights of the layout classifier.

    Labelled rows are the blocks of about ``sample_pages`` pages (at most twice as many), by
    the hash of the row, that stand in a container known as content or boilerplate; of a page
    at most SAMPLE_BLOCKS, evenly spaced. Without both kinds all weights are 0.
    """
    few = sample_rows(pages.filter(F.col(html_col).isNotNull()), sample_pages).select(F.col(html_col).alias("html"))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for page in batch.column(0).to_pylist():
                blocks = blocks_of(page)
                known = np.array([b.state for b in blocks], int)
                use = np.flatnonzero(known)
                use = use[np.unique(np.linspace(0, len(use) - 1, SAMPLE_BLOCKS).astype(int))] if len(use) > SAMPLE_BLOCKS else use
                yield pa.RecordBatch.from_arrays([pa.array(known[use].tolist(), pa.int32()), pa.array(features(blocks)[use].tolist(), pa.list_(pa.float64()))], names=["state", "x"])

    rows = sorted(few.mapInArrow(run, "state int, x array<double>").collect())
    if not rows:
        return np.zeros(8)
    return fit(np.array([r.x for r in rows]), np.array([r.state > 0 for r in rows], int))


def extract_text(pages: DataFrame, html_col: str = "html", text_col: str = "text", costs: Costs = Costs()) -> DataFrame:
    """``pages`` with the main text of each whole page.

    Null and empty pages, and pages without content, get ''. Pages are treated one by
    one, so repeated rows get equal texts and an empty table an empty result. A column
    with the added name is replaced.
    """
    kept = pages.drop(text_col) if text_col != html_col else pages
    weights = train(kept, html_col)
    at, names = kept.columns.index(html_col), [*kept.columns, text_col]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, html_col, 4 << 20):
            texts = [extract(p, weights, costs) for p in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=names)

    return kept.mapInArrow(run, StructType([*kept.schema.fields, StructField(text_col, StringType())]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: main text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract_text(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
