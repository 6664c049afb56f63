"""Main text of web pages: a recurrent network labels every block of a page.

A page is cut into blocks, the runs of text between block-level tags, each with its tag path. A
bidirectional LSTM, in numpy, reads a vector per block (hashed tags, classes and ids of the path,
hashed words, sizes, share of linked text, how much of the page its container holds) over the whole
sequence and gives each block the chance of being main text.

Pages carry no labels. The network learns from the markup of a bounded sample of pages: blocks
inside an article are main text, blocks of navigation, adverts, forms and the like are not. What the
markup says is a label only, never an input. Each sampled page is also learned in altered forms:
containers by other tags and names or by bare ``div`` ones, with other boilerplate from the sample
around and inside the text, so that words, sizes, order and containers must be used as well.

Defined results: null and empty pages give no text; unclosed and stray tags are allowed; text
outside any block-level tag is a block; white space inside a block (``<br>`` too) is one space;
repeated rows give the same text each; extra columns are ignored; an empty table gives an empty
table.
"""

import html
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, fields
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Pages a network is fitted on: those with the least hash of their address and text, of at most so
# many characters. Both bound what reaches the driver.
MOST_PAGES = 120
MOST_CHARS = 1 << 18
# Blocks of a page that are learned from; scoring reads all blocks of all pages.
LEARNED_BLOCKS = 64

PATH_SLOTS, WORD_SLOTS, NUMBERS = 128, 32, 11
WIDTH = PATH_SLOTS + WORD_SLOTS + NUMBERS
HIDDEN = 16

# Tags by their part in the HTML standard.
INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template iframe object svg canvas textarea".split())
CLOSES_ITSELF = {"p": {"p"}, "li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
                 "th": {"td", "th"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
# Tags whose element is a block rather than a container of blocks.
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li td th dt dd blockquote pre figcaption caption span".split())
# Tags and name parts that say what a part of a page is.
MAIN_TAGS = frozenset({"article", "main"})
OTHER_TAGS = frozenset("nav header footer aside form menu dialog head title select button".split())
OTHER_NAMES = (
    "nav", "menu", "breadcrumb", "sidebar", "side-bar", "widget", "related", "footer", "header",
    "masthead", "advert", "ads", "sponsor", "promo", "banner", "cookie", "consent", "notice",
    "popup", "modal", "newsletter", "subscribe", "share", "social", "comment", "disqus", "reply",
    "login", "signup", "search", "pagination", "pager", "copyright", "legal",
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)",
    re.S,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[a-z0-9_\-]+")
_WORD = re.compile(r"\w+")
_CLOSERS = {tag: re.compile(rf"</{tag}\b", re.I) for tag in SILENT}


@dataclass
class Block:
    """path: (tag, names) from the outside in. linked: characters inside links. container: the number
    of the innermost element around it that may hold several blocks; 0 is the page."""

    path: tuple[tuple[str, tuple[str, ...]], ...]
    text: str
    linked: int
    container: int = 0


def page_blocks(page: str) -> list[Block]:
    """The blocks of a page, in page order."""
    blocks: list[Block] = []
    stack: list[tuple[str, tuple[str, ...], int]] = []  # with the number of the element
    pieces: list[str] = []
    linked, in_link, at, opened = 0, 0, 0, 0

    def close_block() -> None:
        nonlocal pieces, linked
        text = " ".join("".join(pieces).split())
        if text:
            around = next((number for tag, _, number in reversed(stack) if tag not in LEAVES), 0)
            blocks.append(Block(tuple((tag, names) for tag, names, _ in stack), text, linked, around))
        pieces, linked = [], 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            text = html.unescape(raw)
            pieces.append(text)
            if in_link:
                linked += len(text.strip())

    while at < len(page):
        found = _TOKEN.search(page, at)
        if found is None:
            add(page[at:])
            break
        add(page[at : found.start()])
        at = found.end()
        tag = found.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "br":
                pieces.append(" ")
            elif tag == "a":
                in_link = 0 if found.group(1) else 1
            continue
        if tag in SILENT:
            if not found.group(1) and not found.group(3).endswith("/"):
                end = _CLOSERS[tag].search(page, at)
                at = len(page) if end is None else end.start()
            continue
        close_block()
        in_link = 0
        if found.group(1):
            names = [part[0] for part in stack]
            if tag in names:
                del stack[len(names) - 1 - names[::-1].index(tag) :]
        elif tag not in VOID:
            while stack and stack[-1][0] in CLOSES_ITSELF.get(tag, ()):
                stack.pop()
            if stack and stack[-1][0] == "p":  # a block-level tag ends an open paragraph
                stack.pop()
            words = [a or b or c for a, b, c in _NAMES.findall(found.group(3))]
            opened += 1
            stack.append((tag, tuple(_PARTS.findall(" ".join(words).lower())), opened))
    close_block()
    return blocks


def slot(kind: str, value: str, slots: int) -> int:
    return zlib.crc32(f"{kind}:{value}".encode()) % slots


def names_other(names: tuple[str, ...]) -> bool:
    """Whether a class, id or role names a part that is not main text."""
    for name in names:
        parts = re.split(r"[-_]", name)
        if "ad" in parts or any(part.startswith(OTHER_NAMES) for part in parts):
            return True
    return False


_path_vectors: dict[tuple, np.ndarray] = {}


def path_vector(path: tuple) -> np.ndarray:
    """Tags and names of a path and the parts of the names, hashed; paths repeat, so they are
    remembered."""
    vector = _path_vectors.get(path)
    if vector is None:
        vector = np.zeros(PATH_SLOTS, np.float32)
        for depth, (tag, names) in enumerate(reversed(path)):
            vector[slot("tag", tag, PATH_SLOTS)] += 1 / (1 + depth)
            for name in names:
                for part in {name, *re.split(r"[-_]", name)} - {""}:
                    vector[slot("name", part, PATH_SLOTS)] += 1 / (1 + depth)
        if len(_path_vectors) > 50_000:
            _path_vectors.clear()
        _path_vectors[path] = vector
    return vector


def block_vectors(blocks: list[Block]) -> np.ndarray:
    """A row per block: path, words and numbers."""
    count = len(blocks)
    rows = np.zeros((count, WIDTH), np.float32)
    if not count:
        return rows
    texts = [block.text for block in blocks]
    words = [[hash_word(word) for word in _WORD.findall(text.lower())] for text in texts]
    many = np.fromiter(map(len, words), np.int64, count)
    slots = np.fromiter((one for some in words for one in some), np.int64, int(many.sum()))
    places = np.repeat(np.arange(count), many) * WORD_SLOTS + slots
    shares = np.bincount(places, minlength=count * WORD_SLOTS).reshape(count, WORD_SLOTS)
    rows[:, :PATH_SLOTS] = [path_vector(block.path) for block in blocks]
    rows[:, PATH_SLOTS : PATH_SLOTS + WORD_SLOTS] = shares / np.maximum(many, 1)[:, None]

    n = np.fromiter(map(len, texts), float, count)
    linked = np.fromiter((block.linked for block in blocks), float, count)
    spaces = np.fromiter((text.count(" ") for text in texts), float, count)
    stops = np.fromiter((text.count(".") + text.count("!") + text.count("?") for text in texts), float, count)
    ends = np.fromiter((text[-1] in ".!?:;\"" for text in texts), float, count)
    depth = np.fromiter((len(block.path) for block in blocks), float, count)
    _, container = np.unique([block.container for block in blocks], return_inverse=True)
    held, members = np.bincount(container, n), np.bincount(container)
    beside = np.zeros(count)
    beside[1:] += container[1:] == container[:-1]
    beside[:-1] += container[:-1] == container[1:]
    rows[:, -NUMBERS:] = np.column_stack([
        np.log1p(n) / 6, np.minimum(1, linked / n), spaces / n * 4, stops / n * 20,
        np.arange(count) / count, ends, held[container] / n.sum(), held[container] / held.max(),
        np.log1p(members[container]) / 4, beside, depth / 10,
    ])
    return rows


@lru_cache(maxsize=1 << 16)
def hash_word(word: str) -> int:
    return zlib.crc32(word.encode()) % WORD_SLOTS


def markup_label(block: Block) -> int:
    """What the markup says: 1 inside an article (or outside all known parts), 0 otherwise."""
    inside = False
    for tag, names in block.path:
        if tag in MAIN_TAGS:
            inside = True
        elif tag in OTHER_TAGS and not (tag == "header" and inside):
            return 0
        if names_other(names):
            return 0
    if inside:
        return 1
    return int(len(block.path) > 0 and block.linked * 2 < len(block.text) and len(block.text) > 40)


# Names that altered forms give to the container of the text, and affixes of names.
MAIN_NAMES = ("content", "post", "entry", "story", "body", "text", "main", "article")
AFFIXES = ("", "", "site-", "page-", "block-", "-box", "-area", "-wrap", "-1")


def altered(blocks: list[Block], labels: list[int], spare: list[str], draw: random.Random):
    """The same page in other markup, with further boilerplate: blocks and labels.

    Blocks of one container stay together. A style has semantic tags or plain ones, and names or
    none; without both, only what the blocks hold and how they lie tells them apart.
    """
    semantic, named = draw.random() < 0.35, draw.random() < 0.5
    numbers = iter(range(1, 1 << 30))

    def names(known: tuple[str, ...]) -> tuple[str, ...]:
        if not named or draw.random() < 0.15:
            return ()
        affix, name = draw.choice(AFFIXES), draw.choice(known)
        return (affix + name if affix.endswith("-") else name + affix,)

    def container(main: bool) -> tuple[tuple, int]:
        if main:
            tag = draw.choice(("article", "main")) if semantic else draw.choice(("div", "div", "section"))
            return (tag, names(MAIN_NAMES)), next(numbers)
        plain = draw.choice(("div", "div", "section", "ul"))
        tag = draw.choice(sorted(OTHER_TAGS - {"head", "title", "select", "button"})) if semantic else plain
        return (tag, names(OTHER_NAMES)), next(numbers)

    frame: list[tuple] = [("html", ()), ("body", ())]
    for _ in range(draw.choice((0, 0, 1, 2))):
        frame.append(("div", names(("page", "wrapper", "container", "layout"))))
    out: list[Block] = []
    out_labels: list[int] = []
    main, main_number = container(True)
    seen: dict[int, tuple] = {}

    def boilerplate(inside: bool) -> None:
        where, number = container(False)
        path = [*frame, main, where] if inside else [*frame, where]
        link = draw.random() < 0.4
        for _ in range(draw.choice((1, 1, 1, 2, 3, 5))):
            text = draw.choice(spare)
            leaf = [] if draw.random() < 0.4 else [(draw.choice(("p", "p", "li", "h3", "span")), ())]
            out.append(Block(tuple([*path, *leaf]), text, len(text) * link, number))
            out_labels.append(0)

    kind = draw.choice(("", "", "", "p", "li", "span", "blockquote"))
    # Some pages hold little text, and short one.
    shown = draw.choice((1, 2, 2, 3)) if draw.random() < 0.25 else len(blocks)
    kept = 0
    for block, label in zip(blocks, labels):
        kept += label
        if label and kept > shown:
            continue
        if label and shown < len(blocks) and draw.random() < 0.5:
            block = Block(block.path, block.text[: draw.randint(1, 30)].strip() or "-", 0)
        if draw.random() < 0.06:
            boilerplate(bool(label) and draw.random() < 0.7)
        last = block.path[-1] if block.path else ("p", ())
        leaf = [(last[0], ())] if last[0] in LEAVES else []
        if label:
            where, number = main, main_number
            leaf = [(kind, ())] if kind else leaf or [("p", ())]
        else:
            where, number = seen.setdefault(block.container, container(False))
        out.append(Block(tuple([*frame, where, *leaf]), block.text, block.linked, number))
        out_labels.append(label)
    boilerplate(False)
    return out, out_labels


@dataclass
class Network:
    """Weights of a bidirectional LSTM and its output layer (gates: in, forget, out, new)."""

    into: np.ndarray  # direction, WIDTH, 4 HIDDEN
    back: np.ndarray  # direction, HIDDEN, 4 HIDDEN
    bias: np.ndarray  # direction, 4 HIDDEN
    out: np.ndarray  # 2 HIDDEN + WIDTH
    base: np.ndarray  # 1


def fresh_network(seed: int = 7) -> Network:
    draw = np.random.default_rng(seed)
    bias = np.zeros((2, 4 * HIDDEN))
    bias[:, HIDDEN : 2 * HIDDEN] = 1
    return Network(
        draw.normal(0, 0.1, (2, WIDTH, 4 * HIDDEN)),
        draw.normal(0, 0.2, (2, HIDDEN, 4 * HIDDEN)),
        bias,
        draw.normal(0, 0.1, 2 * HIDDEN + WIDTH),
        np.zeros(1),
    )


def sigmoid(values: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-values))


def read_sequence(net: Network, direction: int, rows: np.ndarray, mask: np.ndarray, keep: bool):
    """States after each block, of pages x blocks x WIDTH; the steps too, if they are kept."""
    pages, length, _ = rows.shape
    steps = range(length) if direction == 0 else range(length - 1, -1, -1)
    kind = net.into.dtype
    state, cell = np.zeros((pages, HIDDEN), kind), np.zeros((pages, HIDDEN), kind)
    gates_in = rows @ net.into[direction] + net.bias[direction]
    states, trace = np.zeros((pages, length, HIDDEN), kind), {}
    for at in steps:
        gates = gates_in[:, at] + state @ net.back[direction]
        opened = sigmoid(gates[:, : 3 * HIDDEN])
        i, f, o = np.split(opened, 3, axis=1)
        new = np.tanh(gates[:, 3 * HIDDEN :])
        on = mask[:, at : at + 1]
        next_cell = on * (f * cell + i * new) + (1 - on) * cell
        shown = np.tanh(next_cell)
        next_state = on * o * shown + (1 - on) * state
        if keep:
            trace[at] = (i, f, o, new, cell, shown, state)
        state, cell = next_state, next_cell
        states[:, at] = state
    return states, trace


def chances(net: Network, rows: np.ndarray, mask: np.ndarray) -> np.ndarray:
    ahead, _ = read_sequence(net, 0, rows, mask, False)
    behind, _ = read_sequence(net, 1, rows, mask, False)
    return sigmoid(np.concatenate([ahead, behind, rows], axis=2) @ net.out + net.base)


def slopes(net: Network, rows: np.ndarray, mask: np.ndarray, labels: np.ndarray) -> Network:
    """Gradients of the mean logistic loss of all blocks, back through both sequences."""
    runs = [read_sequence(net, direction, rows, mask, True) for direction in (0, 1)]
    seen = np.concatenate([runs[0][0], runs[1][0], rows], axis=2)
    error = (sigmoid(seen @ net.out + net.base) - labels) * mask / mask.sum()
    found = Network(*(np.zeros_like(getattr(net, one.name)) for one in fields(net)))
    found.out[:] = np.einsum("pl,plw->w", error, seen)
    found.base[:] = error.sum()
    length = rows.shape[1]
    for direction, (_, trace) in enumerate(runs):
        weights = net.out[direction * HIDDEN : (direction + 1) * HIDDEN]
        to_state = np.zeros((len(rows), HIDDEN))
        to_cell = np.zeros((len(rows), HIDDEN))
        for at in range(length - 1, -1, -1) if direction == 0 else range(length):
            i, f, o, new, cell, shown, state = trace[at]
            on = mask[:, at : at + 1]
            to_state = to_state + error[:, at : at + 1] * weights
            inner = to_cell + on * to_state * o * (1 - shown**2)
            gates = on * np.concatenate(
                [
                    inner * new * i * (1 - i),
                    inner * cell * f * (1 - f),
                    to_state * shown * o * (1 - o),
                    inner * i * (1 - new**2),
                ],
                axis=1,
            )
            found.into[direction] += rows[:, at].T @ gates
            found.back[direction] += state.T @ gates
            found.bias[direction] += gates.sum(axis=0)
            to_cell = on * inner * f + (1 - on) * to_cell
            to_state = gates @ net.back[direction].T + (1 - on) * to_state
    return found


def padded(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    length = max(map(len, sequences))
    rows = np.zeros((len(sequences), length, WIDTH), np.float32)
    mask = np.zeros((len(sequences), length))
    for number, one in enumerate(sequences):
        rows[number, : len(one)] = one
        mask[number, : len(one)] = 1
    return rows, mask


def fit(pages: list[str], rounds: int = 30, copies: int = 8, rate: float = 0.01) -> Network:
    """A network that agrees with the markup of the pages, also when they are altered."""
    net, draw = fresh_network(), random.Random(11)
    cut = [page_blocks(page) for page in pages]
    told = [[markup_label(block) for block in blocks] for blocks in cut]
    spare = [b.text for blocks, marks in zip(cut, told) for b, m in zip(blocks, marks) if not m]
    examples = []
    for blocks, marks in zip(cut, told):
        if blocks:
            examples.append((blocks, marks))
            body = [(b, m) for b, m in zip(blocks, marks) if not any(t == "head" for t, _ in b.path)]
            for _ in range(copies if spare and body else 0):
                examples.append(altered(*map(list, zip(*body)), spare, draw))
    rows = []
    for blocks, marks in examples:
        vectors = block_vectors(blocks)
        for first in range(0, len(blocks), LEARNED_BLOCKS):
            last = first + LEARNED_BLOCKS
            rows.append((vectors[first:last], np.array(marks[first:last], float)))
    if not rows:
        return net
    rows.sort(key=lambda one: len(one[1]))
    groups = [rows[at : at + 48] for at in range(0, len(rows), 48)]
    momentum = Network(*(np.zeros_like(getattr(net, one.name)) for one in fields(net)))
    power = Network(*(np.zeros_like(getattr(net, one.name)) for one in fields(net)))
    step = 0
    for done in range(rounds):
        pace = rate * (1 - done / rounds)
        draw.shuffle(groups)
        for group in groups:
            step += 1
            data, mask = padded([one for one, _ in group])
            labels = np.zeros(mask.shape)
            for number, (_, marks) in enumerate(group):
                labels[number, : len(marks)] = marks
            found = slopes(net, data, mask, labels)
            for one in fields(net):
                slope = np.clip(getattr(found, one.name), -1, 1)
                m, v = getattr(momentum, one.name), getattr(power, one.name)
                m += 0.1 * (slope - m)
                v += 0.01 * (slope**2 - v)
                weights = getattr(net, one.name)
                weights -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def main_texts(net: Network, pages: list[str], together: int = 128) -> list[str]:
    """The main text of each page; pages of about equal length are read together."""
    cut = [page_blocks(page) for page in pages]
    texts = [""] * len(pages)
    order = sorted((number for number, blocks in enumerate(cut) if blocks), key=lambda n: len(cut[n]))
    at = 0
    while at < len(order):
        longest = len(cut[order[min(at + together, len(order)) - 1]])
        # Fewer pages at a time where they are long, so memory stays bounded.
        size = together if longest <= 400 else max(1, together * 400 // longest)
        some = order[at : at + size]
        at += size
        rows, mask = padded([block_vectors(cut[number]) for number in some])
        told = chances(net, rows, mask) >= 0.5
        for place, number in enumerate(some):
            kept = [block.text for block, main in zip(cut[number], told[place]) if main]
            texts[number] = "\n".join(kept)
    return texts


def train(pages: DataFrame, page: str = "html", url: str = "url", most: int = MOST_PAGES) -> Network:
    """Fitted on a bounded sample of pages."""
    sample = (
        pages.where(F.length(page).between(1, MOST_CHARS))
        .select(F.xxhash64(url, page).alias("draw"), F.col(page).alias("page"))
        .orderBy("draw", "page")
        .limit(most)
    )
    return fit([row["page"] for row in sample.collect()])


def extract(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html"
) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    net = train(pages, page, url)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                some = batch.slice(first, 256)
                texts = main_texts(net, [one or "" for one in some.column(2).to_pylist()])
                sizes = pa.array([len(text) for text in texts], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(texts, pa.string()), sizes],
                    names=["page_id", "url", "text", "n_chars"],
                )

    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(page).alias("page")
    )
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
