"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the DOM."""

from __future__ import annotations

import html
import io
import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.workspace import Workspace

#: Bound of the training sample: so many pages that mark their article, chosen by a hash of the id.
SAMPLE_PAGES = 250
FEATURE_BITS = 14
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Content of these is no text of the page.
SILENT = frozenset("script style head noscript template svg iframe object select textarea button canvas audio video".split())
#: A block ends where one of these starts or ends.
BLOCKS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                   "header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
#: An open element of the key ends when one of the others starts.
CLOSES = {"p": BLOCKS - {"body", "html"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}
#: Content of these is no markup; it ends at the end tag, and where that is missing only the start tag is left out.
RAW = {tag: re.compile(rf"(?i)</{tag}(?=[\s/>])[^>]*>") for tag in ("script", "style", "title", "textarea")}
TOKEN = re.compile(r"""(?s)<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""")
#: A '<' that starts a tag or comment which the page's end cuts off.
CUT = re.compile(r"<(?:[A-Za-z/!?]|\Z)")
ATTRIBUTE = re.compile(r"""(?i)\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
NAMED_VALUE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
HIDING_STYLE = re.compile(r"(?i)(?:^|[;\s])display\s*:\s*none")
SPACE = re.compile(r"\s+")
WORD = re.compile(r"[a-z]+")


class Block:
    __slots__ = ("text", "path", "marks", "linked")

    def __init__(self, text, path, marks, linked):
        self.text, self.path, self.marks, self.linked = text, path, marks, linked


def hides(attributes: str) -> bool:
    """Whether an attribute of its own hides the element: hidden, a style without display, or aria-hidden."""
    for name, *values in NAMED_VALUE.findall(attributes):
        name, value = name.lower(), "".join(values).strip()
        if name == "hidden" or (name == "style" and HIDING_STYLE.search(value)) or (name == "aria-hidden" and value.lower() == "true"):
            return True
    return False


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order: their text, the tags above them, words of class, id and role above them, characters in links."""
    out: list[Block] = []
    stack: list[tuple[str, tuple, bool]] = []
    parts: list[str] = []
    state = {"links": 0}

    def flush():
        text = SPACE.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            out.append(Block(text, tuple(t for t, _, _ in stack), tuple(m for _, ms, _ in stack for m in ms), state["links"]))
        parts.clear()
        state["links"] = 0

    def say(text):
        if text and not any(silent for _, _, silent in stack):
            parts.append(text)
            if any(t == "a" for t, _, _ in stack):
                state["links"] += len(text)

    at = 0
    unclosed = set()
    while m := TOKEN.search(page, at):
        say(page[at:m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if tag in RAW:
            end = None if m[1] or tag in unclosed else RAW[tag].search(page, at)
            if end:
                at = end.end()
            elif not m[1]:
                unclosed.add(tag)
            say(" ")
            continue
        if tag == "br":
            say(" ")
            continue
        if tag in BLOCKS:
            flush()
        if m[1]:
            names = [t for t, _, _ in stack]
            if tag in names:
                del stack[len(names) - 1 - names[::-1].index(tag):]
            continue
        while stack and tag in CLOSES.get(next((t for t, _, _ in reversed(stack) if t in BLOCKS), ""), ()):
            names = [t for t, _, _ in stack]
            last = max(i for i, t in enumerate(names) if t in BLOCKS)
            if names[last] not in CLOSES or tag not in CLOSES[names[last]]:
                break
            del stack[last:]
        if tag not in VOID and not m[3].rstrip().endswith("/"):
            marks = tuple(w for a in ATTRIBUTE.findall(m[3]) for w in WORD.findall((a[1] or a[2] or a[3]).lower())) if m[3] else ()
            silent = tag in SILENT or bool(m[3] and hides(m[3]))
            stack.append((tag, marks, silent))
    tail = page[at:]
    cut = CUT.search(tail)
    say(tail[:cut.start()] if cut else tail)
    flush()
    return out


DIGIT = re.compile(r"\d")


def features(b: Block, i: int, n: int) -> list[str]:
    """Names of what is true of a block, judged by all of its text."""
    size, words, digits = len(b.text), b.text.count(" ") + 1, len(DIGIT.findall(b.text))
    share = b.linked / size
    tags = set(b.path)
    out = ["bias", f"last={b.path[-1] if b.path else ''}", f"words={min(9, words.bit_length())}", f"links={0 if share < .05 else 1 if share < .5 else 2}",
           f"stop={b.text[-1] in '.!?…'}", f"comma={b.text.count(',') > 0}", f"digits={digits > 6 and digits > 0.03 * size}",
           f"first={i == 0}", f"end={i == n - 1}", f"mark={'©' in b.text or b.text.count('·') * 80 > size}"]
    out += [f"in={t}" for t in tags if t in NAMED]
    out += [f"is={w}" for w in {stem(w) for w in b.marks}]
    return out


NAMED = frozenset("article main nav header footer aside form section figure figcaption ul ol li table td th blockquote h1 h2 h3 h4 h5 h6 p div a details dialog pre address".split())


def stem(word: str) -> str:
    return word[:-1] if word.endswith("s") and len(word) > 3 else word


def hashed(names: list[str]) -> np.ndarray:
    return np.array([crc32(x.encode()) % (1 << FEATURE_BITS) for x in names])


class CRF:
    """Two labels (0 other, 1 main text): weights of features by label, of the first label and of each step from label to label."""

    def __init__(self):
        self.w = np.zeros((1 << FEATURE_BITS, 2))
        self.start, self.step = np.zeros(2), np.zeros((2, 2))

    def dump(self) -> bytes:
        np.savez_compressed(out := io.BytesIO(), self.w.astype(np.float32), self.start, self.step)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes):
        model = cls()
        model.w, model.start, model.step = np.load(io.BytesIO(data)).values()
        return model

    def emissions(self, rows: list[np.ndarray]) -> np.ndarray:
        flat = np.concatenate(rows)
        return np.add.reduceat(self.w[flat], np.cumsum([0, *map(len, rows[:-1])]), axis=0)

    def viterbi(self, e: np.ndarray) -> list[int]:
        a, b = e[0] + self.start
        (s00, s01), (s10, s11) = self.step.tolist()
        back = []
        for x, y in e[1:].tolist():
            from0, from1 = int(b + s10 > a + s00), int(b + s11 > a + s01)
            a, b = (b + s10 if from0 else a + s00) + x, (b + s11 if from1 else a + s01) + y
            back.append((from0, from1))
        path = [int(b > a)]
        for step in reversed(back):
            path.append(step[path[-1]])
        return path[::-1]

    def fit(self, pages: list[tuple[list[np.ndarray], np.ndarray]], epochs: int = 8, rate: float = 0.3, decay: float = 1e-4, seed: int = 5):
        """Stochastic gradient of the conditional log-likelihood, by forward and backward sums."""
        rng = np.random.default_rng(seed)
        squares = [np.full_like(x, 1e-3) for x in (self.w, self.start, self.step)]
        for _ in range(epochs):
            for i in rng.permutation(len(pages)):
                rows, y = pages[i]
                e = self.emissions(rows)
                n = len(e)
                fwd, bwd = np.empty((n, 2)), np.zeros((n, 2))
                fwd[0] = self.start + e[0]
                for t in range(1, n):
                    fwd[t] = np.logaddexp(fwd[t - 1, 0] + self.step[0], fwd[t - 1, 1] + self.step[1]) + e[t]
                for t in range(n - 2, -1, -1):
                    nxt = e[t + 1] + bwd[t + 1]
                    bwd[t] = np.logaddexp(self.step[:, 0] + nxt[0], self.step[:, 1] + nxt[1])
                total = np.logaddexp(*fwd[-1])
                p = np.exp(fwd + bwd - total)
                p[np.arange(n), y] -= 1
                steps = np.zeros((2, 2))
                for t in range(1, n):
                    steps += np.exp(fwd[t - 1][:, None] + self.step + (e[t] + bwd[t])[None] - total)
                    steps[y[t - 1], y[t]] -= 1
                flat, sizes = np.concatenate(rows), [len(r) for r in rows]
                used, index = np.unique(flat, return_inverse=True)
                grad = np.zeros((len(used), 2))
                np.add.at(grad, index, np.repeat(p, sizes, axis=0))
                for k, (param, where, g) in enumerate(((self.w, used, grad + decay * self.w[used]), (self.start, slice(None), p[0]), (self.step, slice(None), steps))):
                    squares[k][where] += g * g
                    param[where] -= rate * g / np.sqrt(squares[k][where])
        return self


def in_article(b: Block) -> bool:
    return "article" in b.path and not {"nav", "aside", "footer", "form", "header"} & set(b.path)


#: How other sites mark the same parts: (tag, class) of the container. The training pages are rewritten with them.
MAIN = [("article", ""), ("main", ""), ("div", "content"), ("div", "article body"), ("section", "post entry"), ("div", "main story text"), ("div", "")]
OTHER = [("nav", ""), ("aside", "sidebar"), ("footer", ""), ("header", ""), ("div", "ad advert banner"), ("div", "comments comment"), ("section", "comments"),
         ("div", "cookie notice consent"), ("form", "newsletter signup"), ("div", "sidebar related widget"), ("div", "menu nav"), ("div", "footer legal"),
         ("div", "share social promo"), ("div", "sponsored"), ("ul", "breadcrumb"), ("div", "popup modal"), ("aside", ""), ("ol", "comment list")]


def rewritten(page: list[Block], labels: np.ndarray, rng: np.random.Generator) -> tuple[list[Block], np.ndarray]:
    """The page as another site would mark it: another container for the main text, other kinds of rest around and inside it.

    Text of the rest comes from the page itself, main text included, since readers' comments and notices read like articles.
    """
    some = lambda names: tuple(w for w in names.split() if rng.random() < 0.6) or tuple(names.split()[:1])
    tag, name = MAIN[rng.integers(len(MAIN))]
    top = ("html", "body") if rng.random() < 0.6 else ("html", "body", "div")
    base = some(name)
    main = [Block(b.text, (*top, tag, b.path[-1] if b.path else "p"), base, b.linked) for b, y in zip(page, labels) if y]
    texts = [b.text for b in page]

    def rest():
        kind, marks = OTHER[rng.integers(len(OTHER))]
        leaf = ("li", "a") if kind in ("nav", "ul") or rng.random() < 0.15 else ("p",) if rng.random() < 0.6 else ()
        out = []
        for _ in range(rng.integers(1, 6)):
            text = texts[rng.integers(len(texts))]
            text = text if rng.random() < 0.5 else " ".join(text.split()[:rng.integers(1, 8)])
            out.append(Block(text, (*top, kind, *leaf), some(marks), len(text) if "a" in leaf else 0))
        return out

    def inside():
        return [Block(b.text, (*top, tag, *b.path[len(top):]), base + b.marks, b.linked) for b in rest()]

    rows = [(b, 0) for _ in range(rng.integers(0, 4)) for b in rest()]
    cut = rng.integers(1, len(main) + 1) if main else 0
    rows += [(b, 1) for b in main[:cut]]
    if rng.random() < 0.6:
        rows += [(b, 0) for b in inside()]
    rows += [(b, 1) for b in main[cut:]]
    rows += [(b, 0) for _ in range(rng.integers(0, 4)) for b in rest()]
    return [b for b, _ in rows], np.array([y for _, y in rows])


def train(pages: DataFrame, sample: int = SAMPLE_PAGES) -> bytes:
    """The model's bytes, trained in one task on at most ``sample`` pages with an article element, and rewritten versions of them.

    Without such pages the rewriting rules alone give the training pages.
    """
    marked = pages.filter(F.lower("html").contains("<article")).select(F.xxhash64("page_id", "url").alias("order"), "html").orderBy("order").limit(sample)
    stand_in = pages.sparkSession.createDataFrame([(None, "".join(f"<article><p>One sentence of {i} words, to stand in.</p></article>" for i in range(9)))], "order bigint, html string")

    def fit(key, table):
        rng = np.random.default_rng(9)
        known = []
        for page in table.sort_by("order").column("html").to_pylist():
            found = blocks(page)
            y = np.array([int(in_article(b)) for b in found])
            if y.sum():
                known.append((found, y))
                known += [rewritten(found, y, rng) for _ in range(4)]
        rows = [([hashed(features(b, i, len(bs))) for i, b in enumerate(bs)], y) for bs, y in known if len(bs)]
        return pa.table({"model": pa.array([CRF().fit(rows).dump()], pa.binary())})

    return marked.union(stand_in).withColumn("all", F.lit(0)).groupBy("all").applyInArrow(fit, "model binary").first().model


def extract(pages: DataFrame, work: Workspace, sample: int = SAMPLE_PAGES) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars, n_blocks.

    Null html counts as empty and gives an empty text, as does a page without main text. White space inside a block is one space and blocks
    are joined by a newline. Broken markup is read as a browser would: open elements end with their parent. Repeated rows are read each;
    an empty table gives no rows; other columns are not read. ``work`` is not needed, since the model is all that is kept.
    """
    page = pages.select("page_id", F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    shared = pages.sparkSession.sparkContext.broadcast(train(page, sample))

    def run(batches):
        model, known = CRF.load(shared.value), {}

        def numbers(names):
            for x in names:
                if x not in known:
                    known[x] = crc32(x.encode()) % (1 << FEATURE_BITS)
            return np.array([known[x] for x in names])

        for batch in batches:
            text, count = [], []
            for body in batch.column("html").to_pylist():
                found = blocks(body)
                if len(known) > 100_000:
                    known.clear()
                path = model.viterbi(model.emissions([numbers(features(b, i, len(found))) for i, b in enumerate(found)])) if found else []
                text.append("\n".join(b.text for b, y in zip(found, path) if y))
                count.append(len(found))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()),
                                              pa.array(map(len, text), pa.int64()), pa.array(count, pa.int64())],
                                             ["page_id", "url", "text", "n_chars", "n_blocks"])
    return page.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint, n_blocks bigint")
