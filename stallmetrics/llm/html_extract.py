"""HTML extraction: a recurrent labeller reads a page's blocks in order and marks those of the main text.

A page is cut into leaf blocks, runs of text between block-level tags. Each block is a vector of its tag path (hashed tags,
classes, ids and roles of its ancestors), of its hashed words, and of its length and links. A bidirectional LSTM, in numpy,
reads the vectors of a page in both directions, so that every block is judged with the whole document as context.

There are no labelled pages, so the network learns from rules on paths (main containers hold text, the named kinds of
boilerplate do not) applied to a bounded sample of pages (``SAMPLE`` rows, ``PAGE_BLOCKS`` of each in lessons spread over it) and to
pages made up from their blocks, in which containers of all kinds the rules know are mixed: main blocks of the sample stand in main
containers, boilerplate in the others. In a share of them (``RENAMED``) the names that the rules go by are replaced by names of
no list, so that words, length, links and neighbours have to tell. Training takes place once on the driver, on vectors of the sample.

Defined cases: a null page is an empty one; a page without main text has an empty text. Comments, declarations and the content of
scripts, styles and the like are never blocks. An unclosed comment, script or title ends with the page. A head needs no end tag: what
stands in it besides those is text of the page. Formulas and what stands in for media belong to the block around them; a stray ``<`` is text.
Of an input column named as an added one, the added one remains.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallmetrics.llm.shared import ALNUM_LOWERED, Words, rows_of, without

#: Pages that are learnt from at most, and made-up pages besides.
SAMPLE, MADE_UP = 160, 960
#: Share of made-up pages, and of sampled ones learnt from once more, whose names are in no list.
RENAMED = 0.4
#: A page of the sample is given so many times under unknown names, other ones each time.
UNKNOWN = 3
PATH_SIZE, WORD_SIZE, HIDDEN = 192, 8, 16
PATH_SLOTS, WORD_SLOTS = 4096, 512
EPOCHS, BATCH, RATE, SEED = 14, 32, 0.02, 5
#: Blocks of a lesson, and blocks of a sampled page that are learnt from at most: of a longer page, lessons spread over all of it.
LESSON, PAGE_BLOCKS = 400, 2000
#: Blocks whose vectors are held at once, about.
BLOCKS = 60_000
ADDED = ("main_text",)

# Element and class names with a given role.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby s samp small span strike strong sub sup time tt u var "
    # formulas and what stands in for media: their text belongs to the block around them
    "math semantics annotation mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mmultiscripts mtable mtr mtd mstyle "
    "mpadded menclose object canvas audio video".split()
)
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_CONTENT = frozenset("script style noscript template iframe svg title".split())
CLOSED_BY_BLOCK = frozenset("p".split())
MAIN = frozenset("article main content post entry story articlebody maincontent posttext".split())
BOILERPLATE = frozenset(
    "nav navbar navigation menu header masthead footer aside sidebar ad ads advert adverts advertisement sponsor sponsored promo banner cookie cookies "
    "consent notice notices alert popup modal dialog overlay newsletter subscribe signup login form fieldset button select textarea comment comments "
    "reply replies respond discussion disqus related recommended share sharing social breadcrumb breadcrumbs pagination pager widget copyright "
    "legal disclaimer toolbar search tags hidden".split()
)
ENDS_NAME = frozenset(["", *" \t\n\r\f/>"])
PLAIN_TEXT = frozenset("p h1 h2 h3 h4 h5 h6 li pre blockquote td dd dt figcaption".split())

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^"'>]|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.DOTALL
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_WORD = re.compile(r"[a-z0-9]+")


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    linked: int


def blocks_of(page: str) -> list[Block]:
    """The non-empty leaf blocks of a page, in page order."""
    found: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    pieces: list[str] = []
    state = {"links": 0, "linked": 0}
    lowered = None

    def text(raw: str) -> None:
        if raw:
            pieces.append(raw)
            if state["links"]:
                state["linked"] += len(raw)

    def flush() -> None:
        if pieces:
            plain = " ".join(entities.unescape("".join(pieces)).split())
            if plain:
                found.append(Block(tuple(t for _, names in stack for t in names), plain, min(state["linked"], len(plain))))
            pieces.clear()
            state["linked"] = 0

    at = 0
    while tag := _TAG.search(page, at):
        text(page[at : tag.start()])
        at = tag.end()
        name = (tag[2] or tag[5] or "").lower()
        if not name:
            continue
        if name == "br" or name == "wbr":
            pieces.append(" " if name == "br" else "")
        elif name in INLINE:
            state["links"] = max(0, state["links"] + (-1 if tag[1] or tag[4] else 1)) if name == "a" else state["links"]
        elif tag[1] or tag[4]:
            flush()
            state["links"] = 0
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
        else:
            flush()
            state["links"] = 0
            attributes = tag[3] or tag[6] or ""
            if name in HIDDEN_CONTENT:
                if not attributes.endswith("/"):
                    lowered = page.lower() if lowered is None and len(page.lower()) == len(page) else lowered
                    end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, at) if lowered is None else None
                    if lowered is not None:
                        close = lowered.find(f"</{name}", at)
                        while close >= 0 and lowered[close + 2 + len(name) : close + 3 + len(name)] not in ENDS_NAME:
                            close = lowered.find(f"</{name}", close + 2)
                        stop = lowered.find(">", close) if close >= 0 else -1
                        at = stop + 1 if stop >= 0 else len(page)
                    else:
                        at = end.end() if end else len(page)
                continue
            if name in EMPTY or name == "head":  # whose end tag may be missing
                continue
            if stack and stack[-1][0] in CLOSED_BY_BLOCK:
                stack.pop()
            names = [name]
            if "=" in attributes and name not in ("html", "body"):
                for match in _NAMES.finditer(attributes):
                    names += ["." + w for w in _WORD.findall((match[1] or match[2] or match[3] or "").lower())]
            stack.append((name, tuple(names)))
    text(page[at:])
    flush()
    return found


def labels_by_rule(paths: list[tuple[str, ...]]) -> list[int]:
    """What the rules on paths say: in a main container, or plain text of a page without one, and in no boilerplate."""
    clean = [not any(t.lstrip(".") in BOILERPLATE for t in path) for path in paths]
    main = [any(t.lstrip(".") in MAIN for t in path) for path in paths]
    if not any(c and m for c, m in zip(clean, main, strict=True)):
        main = [any(t in PLAIN_TEXT for t in path) for path in paths]
    return [int(c and m) for c, m in zip(clean, main, strict=True)]


def _tables() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(SEED)
    return tuple(random.standard_normal(s).astype(np.float32) for s in ((PATH_SLOTS, PATH_SIZE), (WORD_SLOTS, WORD_SIZE)))


_PATHS, _WORDS_TABLE = _tables()
INPUT = PATH_SIZE + WORD_SIZE + 3


def path_vector(path: tuple[str, ...]) -> np.ndarray:
    import zlib

    slots = {zlib.crc32(t.lstrip(".").encode()) % PATH_SLOTS for t in path}
    return _PATHS[sorted(slots)].sum(axis=0) / 3 if slots else np.zeros(PATH_SIZE, np.float32)


def block_vectors(blocks: list[Block], seen: dict[tuple[str, ...], np.ndarray]) -> np.ndarray:
    out = np.zeros((len(blocks), INPUT), np.float32)
    for i, b in enumerate(blocks):
        if b.path not in seen:
            if len(seen) > 50_000:
                seen.clear()
            seen[b.path] = path_vector(b.path)
        out[i, :PATH_SIZE] = seen[b.path]
    words = Words([b.text.encode("utf-8", "replace") for b in blocks], ALNUM_LOWERED)
    total = int(words.first[-1])
    if total:
        number = np.arange(total)
        slots = (words.ranges(number, number) % np.uint64(WORD_SLOTS)).astype(np.int64)
        some = words.counts > 0
        sums = np.add.reduceat(_WORDS_TABLE[slots], words.first[:-1][some], axis=0)
        out[some, PATH_SIZE : PATH_SIZE + WORD_SIZE] = sums / words.counts[some, None]
    sizes = np.array([len(b.text) for b in blocks], np.float32)
    out[:, -3] = np.log1p(sizes) / 8
    out[:, -2] = np.array([b.linked for b in blocks], np.float32) / np.maximum(1, sizes)
    out[:, -1] = 1
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Labeller:
    """Weights of both directions and of the output."""

    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def fresh() -> Labeller:
        random = np.random.default_rng(SEED)
        weights = {}
        for d in "fb":
            weights[f"w{d}"] = (random.standard_normal((INPUT, 4 * HIDDEN)) / np.sqrt(INPUT)).astype(np.float32)
            weights[f"u{d}"] = (random.standard_normal((HIDDEN, 4 * HIDDEN)) / np.sqrt(HIDDEN)).astype(np.float32)
            weights[f"c{d}"] = np.repeat(np.array([0, 1, 0, 0], np.float32), HIDDEN)
        weights["o"] = (random.standard_normal(2 * HIDDEN) / np.sqrt(HIDDEN)).astype(np.float32)
        weights["p"] = np.zeros(1, np.float32)
        return Labeller(weights)

    def direction(self, x: np.ndarray, d: str, keep: bool):
        """Hidden states (time, row, hidden) over left-aligned rows; ``keep``: also what learning needs."""
        w, u, c = (self.weights[f"{k}{d}"] for k in "wuc")
        time, rows, _ = x.shape
        gates = (x.reshape(-1, x.shape[2]) @ w + c).reshape(time, rows, -1)
        h, cell = np.zeros((rows, HIDDEN), np.float32), np.zeros((rows, HIDDEN), np.float32)
        states, kept = np.empty((time, rows, HIDDEN), np.float32), []
        for t in range(time):
            z = gates[t] + h @ u
            s = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :]
            g, before = np.tanh(z[:, 3 * HIDDEN :]), cell
            cell = f * cell + i * g
            squashed = np.tanh(cell)
            if keep:
                kept.append((i, f, o, g, before, squashed, h))
            h = o * squashed
            states[t] = h
        return states, kept

    def probabilities(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        turned = _turned(lengths, len(x))
        forward, _ = self.direction(x, "f", False)
        backward, _ = self.direction(np.take_along_axis(x, turned[:, :, None], 0), "b", False)
        both = np.concatenate((forward, np.take_along_axis(backward, turned[:, :, None], 0)), axis=2)
        return _sigmoid(both @ self.weights["o"] + self.weights["p"])

    def gradients(self, x: np.ndarray, lengths: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy over all blocks."""
        turned = _turned(lengths, len(x))
        inside = np.arange(len(x))[:, None] < lengths
        sides = {"f": x, "b": np.take_along_axis(x, turned[:, :, None], 0)}
        runs = {d: self.direction(v, d, True) for d, v in sides.items()}
        backward = np.take_along_axis(runs["b"][0], turned[:, :, None], 0)
        both = np.concatenate((runs["f"][0], backward), axis=2)
        error = np.where(inside, _sigmoid(both @ self.weights["o"] + self.weights["p"]) - y, 0) / inside.sum()
        out = {"o": np.einsum("tn,tnh->h", error, both), "p": np.array([error.sum()])}
        back = error[:, :, None] * self.weights["o"]
        flows = {"f": back[:, :, :HIDDEN], "b": np.take_along_axis(back[:, :, HIDDEN:], turned[:, :, None], 0)}
        for d, flow in flows.items():
            u, gate = self.weights[f"u{d}"], np.empty((*flow.shape[:2], 4 * HIDDEN), np.float32)
            later_h, later_c = np.zeros_like(flow[0]), np.zeros_like(flow[0])
            du = np.zeros_like(u)
            for t in range(len(flow) - 1, -1, -1):
                i, f, o, g, before, squashed, h = runs[d][1][t]
                dh = flow[t] + later_h
                dc = later_c + dh * o * (1 - squashed * squashed)
                gate[t] = np.concatenate((dc * g * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g * g)), axis=1)
                later_c, later_h = dc * f, gate[t] @ u.T
                du += h.T @ gate[t]
            flat = gate.reshape(-1, 4 * HIDDEN)
            out |= {f"u{d}": du, f"w{d}": sides[d].reshape(len(flat), -1).T @ flat, f"c{d}": flat.sum(axis=0)}
        return out


def _turned(lengths: np.ndarray, time: int) -> np.ndarray:
    """Indexes that turn the first ``length`` entries of each row around and leave the padding in its place."""
    t = np.arange(time)[:, None]
    return np.where(t < lengths, lengths - 1 - t, t)


def _padded(vectors: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(v) for v in vectors])
    x = np.zeros((int(lengths.max()), len(vectors), vectors[0].shape[1]), np.float32)
    for i, v in enumerate(vectors):
        x[: len(v), i] = v
    return x, lengths


Page = list[tuple[tuple[str, ...], np.ndarray]]


def made_up_pages(pages: list[Page], count: int) -> list[Page]:
    """Pages of the blocks' vectors under random containers: main blocks in main ones, others in boilerplate, as the rules know them."""
    random = np.random.default_rng(SEED)
    pools: tuple[list, list] = ([], [])
    for page in pages:
        for label, (_, vector) in zip(labels_by_rule([p for p, _ in page]), page, strict=True):
            pools[label].append(vector)
    if not pools[0] and not pools[1]:
        return []
    pools = pools[0] or pools[1], pools[1] or pools[0]
    boiler, main, inner = sorted(BOILERPLATE), sorted(MAIN), ["p", "p", "p", "h2", "li", "div", "td", "blockquote"]
    outer = [("div",), ("div", ".wrapper"), ("section",), ("div", ".row"), ()]

    def some(container: tuple[str, ...], most: int, label: int) -> list:
        out = []
        for _ in range(int(random.integers(1, most + 1))):
            leaf = inner[random.integers(len(inner))]
            if leaf == "div" and container == bare:
                leaf = "p"  # without a main container only plain text is main
            pool = pools[label]
            out.append(((*container, *(("ul", leaf) if leaf == "li" else (leaf,))), pool[random.integers(len(pool))]))
        return out

    def name(choice: list[str]) -> tuple[str, ...]:
        word = choice[random.integers(len(choice))]
        return (word,) if random.random() < 0.5 else (("div", "section")[random.integers(2)], "." + word)

    made, bare = [], ()
    for _ in range(count):
        base = ("html", "body", *outer[random.integers(len(outer))])
        body = (*base, *name(main)) if random.random() < 0.85 else base
        bare = base
        page = []
        for _ in range(int(random.integers(0, 4))):
            page += some((*base, *name(boiler)), 6, 0)
        for _ in range(int(random.integers(1, 4))):
            page += some(body, 14, 1)
            if random.random() < 0.4:
                page += some((*body, *name(boiler)), 5, 0)
        for _ in range(int(random.integers(0, 4))):
            page += some((*base, *name(boiler)), 6, 0)
        made.append(page)
    return made


def renamed(paths: list[tuple[str, ...]], random: np.random.Generator) -> list[tuple[str, ...]]:
    """The paths of a page with every name that a rule goes by replaced: elements by ``div``, names by one of no list."""
    names: dict[str, str] = {}

    def other(name: str) -> str:
        if name.lstrip(".") not in BOILERPLATE | MAIN:
            return name
        return names.setdefault(name, f".x{random.integers(1 << 30)}" if name[0] == "." else "div")

    return [tuple(other(n) for n in path) for path in paths]


def lesson_blocks(blocks: int, most: int = PAGE_BLOCKS) -> np.ndarray:
    """Numbers of the blocks to learn from: all, or whole lessons from the first block to the last, at even distances."""
    if blocks <= most:
        return np.arange(blocks)
    lessons = max(1, most // LESSON)
    starts = np.linspace(0, blocks - LESSON, lessons).astype(int) if lessons > 1 else np.array([blocks - LESSON])
    return (starts[:, None] + np.arange(LESSON)).reshape(-1) if blocks >= lessons * LESSON else np.arange(blocks)


def train(pages: list[list[tuple[tuple[str, ...], np.ndarray]]]) -> Labeller:
    """A labeller from pages of (path, vector); the path part of a vector is made from the path."""
    made = made_up_pages(pages, MADE_UP)
    blank = int(RENAMED * len(made))
    everything = [(p, False) for p in [*pages, *made[blank:]] if p] + [(p, True) for p in [*pages * UNKNOWN, *made[:blank]] if p]
    model = Labeller.fresh()
    if not everything:
        return model
    vectors, targets, chance = [], [], np.random.default_rng(SEED + 1)
    for page, nameless in everything:
        rows, paths = np.array([v for _, v in page], np.float32), [p for p, _ in page]
        rows[:, :PATH_SIZE] = [path_vector(p) for p in (renamed(paths, chance) if nameless else paths)]
        labels = np.array(labels_by_rule(paths), np.float32)
        for start in range(0, len(page), LESSON):
            vectors.append(rows[start : start + LESSON])
            targets.append(labels[start : start + LESSON])
    random, step = np.random.default_rng(SEED), 0
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    for epoch in range(EPOCHS):
        order = random.permutation(len(vectors))
        for start in range(0, len(order), BATCH):
            batch = order[start : start + BATCH]
            x, lengths = _padded([vectors[i] for i in batch])
            y, _ = _padded([targets[i][:, None] for i in batch])
            step += 1
            rate = RATE * (1 - epoch / EPOCHS) + 0.001
            for k, g in model.gradients(x, lengths, y[:, :, 0]).items():
                g = np.clip(g, -1, 1)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                model.weights[k] = (model.weights[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def fit(pages: DataFrame, *, html: str = "html", key: str = "page_id", sample: int = SAMPLE, most: int = PAGE_BLOCKS) -> Labeller:
    """A labeller learnt from at most ``sample`` of the pages, picked by a hash of their key, and ``most`` blocks of each."""
    chosen = pages.where(F.col(html).isNotNull()).orderBy(F.xxhash64(key, F.lit(SEED)), key, F.xxhash64(html)).limit(sample).select(F.col(html).alias("html"))

    def vectors(batches):
        seen: dict = {}
        for _, texts in rows_of(batches, "html"):
            parsed = [blocks_of(t.decode("utf-8", "replace")) for t in texts]
            taught = [lesson_blocks(len(p), most) for p in parsed]
            yield pa.RecordBatch.from_pydict({
                "paths": pa.array([[" ".join(p[k].path) for k in at] for p, at in zip(parsed, taught, strict=True)], pa.list_(pa.string())),
                "vectors": pa.array([block_vectors(p, seen)[at].tobytes() if p else b"" for p, at in zip(parsed, taught, strict=True)], pa.binary()),
            })

    rows = chosen.mapInArrow(vectors, "paths array<string>, vectors binary").collect()  # at most ``sample`` pages of ``most`` blocks
    learnt = []
    for row in sorted(rows, key=lambda r: (len(r.paths), bytes(r.vectors))):
        learnt.append(list(zip([tuple(p.split()) for p in row.paths], np.frombuffer(row.vectors, np.float32).reshape(-1, INPUT), strict=True)))
    return train(learnt)


def main_texts(pages: list[list[Block]], model: Labeller, seen: dict) -> list[str]:
    """Of every page, the text of the blocks that the labeller marks."""
    out = [""] * len(pages)
    order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
    start = 0
    while start < len(order):
        stop = start + 1  # pages of similar length, so that little is padded
        while stop < len(order) and (stop - start + 1) * len(pages[order[stop]]) <= BLOCKS // 4 and len(pages[order[stop]]) <= 2 * len(pages[order[start]]) + 8:
            stop += 1
        group = [pages[i] for i in order[start:stop]]
        vectors = block_vectors([b for p in group for b in p], seen)
        cuts = np.cumsum([len(p) for p in group])[:-1]
        x, lengths = _padded(np.split(vectors, cuts))
        marks = model.probabilities(x, lengths) >= 0.5
        for k, i in enumerate(order[start:stop]):
            out[i] = " ".join(b.text for b, m in zip(pages[i], marks[:, k], strict=False) if m)
        start = stop
    return out


def extract(pages: DataFrame, model: Labeller, *, html: str = "html") -> DataFrame:
    """``pages`` with ``main_text``."""
    handle = pages.sparkSession.sparkContext.broadcast(model)
    source = without(pages, *ADDED)

    def label(batches):
        seen: dict = {}
        for batch, texts in rows_of(batches, html):
            found = main_texts([blocks_of(t.decode("utf-8", "replace")) for t in texts], handle.value, seen)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, *ADDED])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema)
    return source.mapInArrow(label, f"{fields}, main_text string")


def extraction_report(pages: DataFrame) -> DataFrame:
    found = extract(pages.select("page_id", "url", "html"), fit(pages))
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))
