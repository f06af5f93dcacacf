"""Secrets: fixed patterns, and a character convolutional network that adds spans.

The patterns give the base spans. Every other candidate, a long run of key characters with
a digit and a letter, is scored with its surroundings by a small network in numpy: character
classes embedded, one convolution, the maximum over places, a hidden layer, a logistic
output. It learns from all
texts: values of the base patterns, also spelled in other alphabets, against runs that are
surely no secret (words, and names and paths made of words that other texts use), each also
with the surroundings blanked, and values also in the surroundings of plain runs. Any other run
may be a key no pattern knows and teaches nothing.

Spark finds the examples, each different one once, and cuts them into shards by hash. The network
gets its first values from a few examples of each label; then every shard goes on from there with
all its examples, a half in each round, and the mean over the shards, by their examples, is the
next network. A fifth of the strings, by hash, is held back with all that spells or repeats them.
Their scores, counted in steps of 1 / ``STEPS``, calibrate the probabilities and set the threshold:
even odds, or less where the required share of the base values held back asks for it. Of keys
without a base pattern no labels exist, so the share found of them is not known.

Results in odd cases: a null or empty text has no spans; repeated rows get a row each;
with hardly any finding in all texts the network adds nothing; other columns are not read. Long
texts are scanned whole; a candidate above ``INSIDE`` characters is judged by the likeliest of
overlapping windows over all of it.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, cycle, islice
from string import ascii_letters, digits
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunloom.llm.common import slices, touching
from sunloom.session import materialise

KINDS = ("assign", "access", "hex")
ADDED = "network"
# A name is made of the words after every so many characters of a text.
NAMES = 500
# A known word is one of so many (text, word) pairs, so there are at most as many known words.
PAIRS = 1_000_000
# Words a task counts before it hands them on, and characters whose words it finds together.
HELD_WORDS, TOGETHER = 200_000, 1_000_000
# Examples of each label that give the first values, and the windows drawn from them.
FIRST, FIRST_WINDOWS = 2048, 40_000
# Examples of a shard, and rounds of shards; each example teaches in one round.
SHARD, ROUNDS = 65_536, 2
RATE, LATER_RATE = 0.004, 0.002
# One of so many strings is held back; scores are counted in steps of this part of a logit.
FOLDS, STEPS = 5, 256
BEFORE, INSIDE, AFTER = 24, 48, 8
RECALL = 0.98
# A run is added at the latest from this probability on, at a lower one where the recall asks for it.
MOST_PROBABILITY = 0.5

Span = tuple[str, int, int]

_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A
)
# A text without any of these, lowered, has no assignment.
_NAMES = (b"passw", b"secret", b"token", b"api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-][A-Za-z0-9+/_.=-]{14,}[A-Za-z0-9+/_=-]")
_DIGIT, _LETTER = re.compile(r"[0-9]"), re.compile(r"[A-Za-z]")
# For each byte of ``narrow``, whether it stands for a character of a key.
_KEY = bytes(chr(b) in ascii_letters + digits + "+/_.=-" for b in range(256))


def narrow(text: str) -> bytes:
    """A byte for each character: ASCII as it is, but a blank for ``?``, which stands for all beyond Latin-1."""
    return text.replace("?", " ").encode("latin-1", "replace")


def long_runs(line: bytes, table: bytes, least: int) -> Iterator[tuple[int, int]]:
    """The longest runs of bytes that the table gives 1, of ``least`` and more."""
    marks, run, end = line.translate(table), b"\1" * least, 0
    while (start := marks.find(run, end)) >= 0:
        end = marks.find(b"\0", start)
        if end < 0:
            end = len(marks)
        yield start, end


def key_runs(line: bytes) -> list[tuple[int, int]]:
    """Where keys by their look, hexadecimal runs and candidates can be."""
    return list(long_runs(line, _KEY, 16))


def base_spans(text: str | None) -> list[Span]:
    """Spans of the fixed patterns, by start, then by kind as listed."""
    if not text:
        return []
    line = narrow(text)
    return base_within(text, line, key_runs(line))


def base_within(text: str, line: bytes, runs: list[tuple[int, int]]) -> list[Span]:
    """The base spans of a text with its ``narrow`` form and that form's ``key_runs``."""
    spans: list[Span] = []
    lowered = line.lower()
    if any(name in lowered for name in _NAMES):
        spans += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if b"AKIA" in line:
        spans += [("access", *m.span()) for run in runs for m in _ACCESS.finditer(text, *run)]
    spans += [("hex", *m.span()) for run in runs for m in _HEX.finditer(text, *run)]
    return by_start(spans)


def by_start(spans: list[Span]) -> list[Span]:
    order = (*KINDS, ADDED)
    return sorted(spans, key=lambda s: (s[1], order.index(s[0])))


def candidates(text: str, runs: list[tuple[int, int]], base: list[Span], need_digit: bool = True) -> list[tuple[int, int]]:
    """Long runs of key characters, in the ``key_runs``, that no base span touches."""
    out, taken = [], touching((a, b) for _, a, b in base)
    for m in chain.from_iterable(_CANDIDATE.finditer(text, *run) for run in runs):
        a, b = m.span()
        if need_digit and not (_DIGIT.search(text, a, b) and _LETTER.search(text, a, b)):
            continue
        if not taken(a, b):
            out.append((a, b))
    return out


# Classes of characters: the printable ones of ASCII, line ends, other letters, the rest.
N_CLASSES = 100


class _Classes(dict):
    def __missing__(self, code: int) -> str:
        c = chr(code)
        out = chr(code - 31 if 32 <= code < 127 else 96 if c in "\r\n" else 97 if c.isalpha() else 98)
        if code < 0x10000:
            self[code] = out
        return out


_CLASS_OF = _Classes()


# What the window of a candidate shows: before it, of it, behind it.
Parts = tuple[str, str, str]


def parts_of(text: str, start: int, end: int, blank: bool = False) -> Parts:
    inner = text[start : min(end, start + INSIDE)]
    return ("", inner, "") if blank else (text[max(0, start - BEFORE) : start], inner, text[end : end + AFTER])


def encode(text: str, start: int, end: int, blank: bool = False) -> np.ndarray:
    return encode_all([parts_of(text, start, end, blank)])[0]


def encode_all(shown: list[Parts]) -> np.ndarray:
    """Class of each place of each window; 0 is nothing. The second row marks the candidate."""
    windows = np.zeros((len(shown), 2, BEFORE + INSIDE + AFTER), dtype=np.int64)
    sizes = np.array([(len(left), len(inner), len(right)) for left, inner, right in shown], dtype=np.int64).reshape(-1, 3)
    place = np.arange(windows.shape[2])
    left, inner, right = sizes.T[:, :, None]
    windows[:, 1] = inside = (place >= BEFORE) & (place < BEFORE + inner)
    filled = inside | (place >= BEFORE - left) & (place < BEFORE) | (place >= BEFORE + INSIDE) & (place < BEFORE + INSIDE + right)
    classes = "".join(chain.from_iterable(shown)).translate(_CLASS_OF)
    windows[:, 0][filled] = np.frombuffer(classes.encode("latin-1"), np.uint8)
    return windows


def stretches(a: int, b: int) -> list[tuple[int, int]]:
    """Overlapping parts of at most ``INSIDE`` characters that cover a candidate; the last
    ends with it."""
    starts = [*range(a, b - INSIDE, INSIDE // 2), max(a, b - INSIDE)]
    return [(at, min(at + INSIDE, b)) for at in starts]


EMBED, WIDTH, FILTERS, HIDDEN = 8, 5, 24, 16


@dataclass
class Network:
    params: dict[str, np.ndarray]
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 2.0

    def logits(self, windows: np.ndarray) -> np.ndarray:
        return _forward(self.params, windows)[0]

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """Calibrated probability that a candidate is a secret."""
        return self.chances(self.logits(windows))

    def chances(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * logits + self.shift, -30, 30)))


def _forward(p: dict[str, np.ndarray], windows: np.ndarray):
    # Rows of the classes outside the candidate, then of those inside.
    marked = np.stack([np.insert(p["embed"], EMBED, mark, axis=1) for mark in (0, 1)]).reshape(-1, EMBED + 1)
    view = np.lib.stride_tricks.sliding_window_view(windows[:, 0] + N_CLASSES * windows[:, 1], WIDTH, axis=1)
    patches = marked.take(view, axis=0).reshape(*view.shape[:2], WIDTH * (EMBED + 1))
    conv = patches @ p["kernel"]
    conv += p["bias"]
    np.maximum(conv, 0, out=conv)
    # Maxima and means over places, which are quicker with the places in front.
    by_place = conv.transpose(1, 0, 2).copy()
    pooled = np.concatenate([by_place.max(axis=0), by_place.mean(axis=0)], axis=1)
    hidden = np.maximum(pooled @ p["w1"] + p["b1"], 0)
    return hidden @ p["w2"] + p["b2"][0], (patches, conv, pooled, hidden)


def _gradients(p: dict[str, np.ndarray], windows: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    z, (patches, conv, pooled, hidden) = _forward(p, windows)
    n, places, _ = conv.shape
    dz = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n
    grads = {"w2": hidden.T @ dz, "b2": np.array([dz.sum()])}
    dh = np.outer(dz, p["w2"]) * (hidden > 0)
    grads |= {"w1": pooled.T @ dh, "b1": dh.sum(axis=0)}
    dp = dh @ p["w1"].T
    dconv = (conv > 0) * (dp[:, None, FILTERS:] / places)
    rows, filters = np.arange(n)[:, None], np.arange(FILTERS)
    dconv[rows, conv.argmax(axis=1), filters] += dp[:, :FILTERS] * (pooled[:, :FILTERS] > 0)
    flat = dconv.reshape(-1, FILTERS)
    grads |= {"kernel": patches.reshape(len(flat), -1).T @ flat, "bias": flat.sum(axis=0)}
    # Of the embedding only, a row for each of its parts.
    weights = p["kernel"].reshape(WIDTH, EMBED + 1, FILTERS)[:, :EMBED]
    dpatch = (weights.reshape(-1, FILTERS) @ flat.T).reshape(WIDTH, EMBED, n, places)
    dx = np.zeros((EMBED, n, windows.shape[2]), dpatch.dtype)
    for k in range(WIDTH):
        dx[:, :, k : k + places] += dpatch[k]
    classes = windows[:, 0].ravel()
    embed = [np.bincount(classes, part.ravel(), N_CLASSES) for part in dx]
    return grads | {"embed": np.stack(embed, axis=1)}


def first_params(rng: np.random.Generator) -> dict[str, np.ndarray]:
    shapes = {
        "embed": (N_CLASSES, EMBED), "kernel": (WIDTH * (EMBED + 1), FILTERS), "bias": (FILTERS,),
        "w1": (2 * FILTERS, HIDDEN), "b1": (HIDDEN,), "w2": (HIDDEN,), "b2": (1,),
    }
    return {
        k: (rng.normal(0, 1 / np.sqrt(s[0] if k != "embed" else 4), s) if k[0] != "b" else np.zeros(s)).astype(np.float32)
        for k, s in shapes.items()
    }


def descend(
    params: dict[str, np.ndarray], batches: Iterable[tuple[np.ndarray, np.ndarray]], rate: float
) -> dict[str, np.ndarray]:
    """The parameters after a step on each batch of windows and labels."""
    p = {k: v.copy() for k, v in params.items()}
    moment, spread = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    for turn, (windows, y) in enumerate(batches, 1):
        for k, g in _gradients(p, windows, y).items():
            moment[k] = 0.9 * moment[k] + 0.1 * g
            spread[k] = 0.999 * spread[k] + 0.001 * g * g
            p[k] -= (rate * moment[k] / (1 - 0.9**turn) / (np.sqrt(spread[k] / (1 - 0.999**turn)) + 1e-8)).astype(p[k].dtype)
    return p


def settled(params: dict[str, np.ndarray], z: np.ndarray, y: np.ndarray, n: np.ndarray) -> Network:
    """The network with its calibration and threshold, by ``n`` held-back scores of each logit and label."""
    net = Network(params)
    total = [n[y == label].sum() for label in (0, 1)]
    # Both labels weigh the same.
    net.scale, net.shift = _calibrate(z, y, n * (min(total) / np.maximum(np.where(y == 1, total[1], total[0]), 1)))
    if total[1]:
        # So many held-back findings may be missed.
        order = np.argsort(z[y == 1])
        least = z[y == 1][order][np.searchsorted(n[y == 1][order].cumsum(), int((1 - RECALL) * total[1]), side="right")]
        net.threshold = min(MOST_PROBABILITY, float(net.chances(least)))
    return net


def fit_network(
    windows: np.ndarray,
    y: np.ndarray,
    epochs: int = 12,
    batch: int = 64,
    rate: float = 0.01,
    groups: np.ndarray | None = None,
) -> Network:
    """Train on four fifths of the groups of few windows; calibrate and set the threshold on the rest.

    Examples of one group (by default each its own) are never on both sides.
    """
    rng = np.random.default_rng(7)
    first = first_params(rng)
    held, taught = _held_back(np.arange(len(y)) if groups is None else groups, y, rng)

    def batches():
        for _ in range(epochs):
            order = rng.permutation(taught)
            for at in range(0, len(order), batch):
                yield windows[order[at : at + batch]], y[order[at : at + batch]]

    params = descend(first, batches(), rate)
    return settled(params, Network(params).logits(windows[held]), y[held], np.ones(len(held)))


def _held_back(groups: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Examples of a fifth of each label's groups, and of the others."""
    back: list[int] = []
    for label in (0, 1):
        of_label = rng.permutation(np.unique(groups[y == label]))
        back += of_label[: len(of_label) // 5].tolist()
    held = np.isin(groups, back)
    return np.flatnonzero(held), rng.permutation(np.flatnonzero(~held))


def _calibrate(z: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Logistic fit of the labels on the scores, ``n`` of each, held towards the scores as they are."""
    x, w = np.stack([z, np.ones_like(z)], axis=1).astype(float), np.array([1.0, 0.0])
    for _ in range(25):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (y - q)) - (w - [1.0, 0.0])
        w = w + np.linalg.solve((x * (n * q * (1 - q))[:, None]).T @ x + np.eye(2), slope)
    return (float(w[0]), float(w[1])) if w[0] > 0 else (1.0, 0.0)


_WORD = re.compile(r"[A-Za-z]{4,}")
_PART = re.compile(r"([A-Za-z]*)([0-9]*)")
# Tried within runs of ASCII letters and anything beyond ASCII, which are found faster.
_LETTER_OR_BEYOND = bytes(b >= 128 or chr(b) in ascii_letters + "?" for b in range(256))
_LONG_WORD = re.compile(r"[^\W\d_]{12,}")
_ALPHABETS = ("0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")


def _even_case(word: str | bytes) -> bool:
    return word.islower() or word.isupper() or word.istitle()


_LETTERS = bytes(b if chr(b) in ascii_letters else 32 for b in range(256))


def text_words(text: str) -> set[bytes]:
    """Words of 4 to 15 letters of a text, lowered; no candidate by themselves."""
    words = set(text.encode().translate(_LETTERS).split())
    return {w.lower() for w in words if 4 <= len(w) <= 15 and _even_case(w)}


def known_words(texts: list[str]) -> set[str]:
    """Words that two texts use."""
    seen = Counter(w for t in texts for w in text_words(t))
    return {w.decode() for w, n in seen.items() if n > 1}


# For each size of a word, ones in so many of sixteen bytes; ``_SMALL`` is the bit that tells small letters.
_SIZED = ((np.arange(16) < np.arange(16)[:, None]) * np.uint8(255)).view(np.uint64)
_SMALL, _FIRST_SMALL = (np.array(b, np.uint8).view(np.uint64) for b in ([32] * 16, [32] + [0] * 15))


def counted_words(texts: list[str], hashes: np.ndarray) -> pa.Table:
    """Each of the ``text_words`` of all the texts, in sixteen bytes with zeros behind: how many texts
    use it, their least and greatest hash."""
    encoded = [t.encode() for t in texts]
    line = np.frombuffer(b" ".join([b"", *encoded, bytes(16)]).translate(_LETTERS), np.uint8)
    letter = line != 32
    edges = np.flatnonzero(letter[1:] != letter[:-1]) + 1
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    fits = (sizes >= 4) & (sizes <= 15)
    starts, sized = starts[fits], _SIZED[sizes[fits]]
    words = np.lib.stride_tricks.sliding_window_view(line, 16)[starts].view(np.uint64) & sized
    small, every = words & _SMALL, sized & _SMALL

    def equal(bits):
        return (small[:, 0] == bits[:, 0]) & (small[:, 1] == bits[:, 1])

    # As ``_even_case``: small letters only, none, or all but the first.
    even = equal(every) | equal(np.zeros_like(every)) | equal(every & ~_FIRST_SMALL)
    words = (words | every)[even]
    coded = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(words), [None, pa.py_buffer(words)]).dictionary_encode()
    text = np.searchsorted(np.cumsum([len(e) + 1 for e in encoded]), starts[even], side="right")
    # A word counts once in a text.
    pairs = np.sort(coded.indices.to_numpy().astype(np.int64) * len(texts) + text)
    pairs = pairs[np.diff(pairs, prepend=-1) > 0]
    n = np.bincount(pairs // len(texts))
    first, hashes = np.cumsum(n) - n, hashes[pairs % len(texts)]
    columns = [n, np.minimum.reduceat(hashes, first), np.maximum.reduceat(hashes, first)] if len(n) else [hashes[:0]] * 3
    return pa.table([coded.dictionary, *columns], ["word", "n", "lo", "hi"])


def added_up(counts: list[pa.Table]) -> pa.Table:
    """Tables of ``counted_words`` as one, each word once."""
    one = pa.concat_tables(counts).group_by("word", use_threads=False)
    return one.aggregate([("n", "sum"), ("lo", "min"), ("hi", "max")]).rename_columns(["word", "n", "lo", "hi"])


def surely_plain(run: str, known: set[str]) -> bool:
    """Whether a run is words and short numbers between marks, half of it or more known words."""
    letters = 0
    for part in re.split(r"[+/_.=-]+", run):
        m = _PART.fullmatch(part)
        if not m or len(m[2]) > (4 if m[1] else 8) or m[1] and not _even_case(m[1]):
            return False
        if m[1].lower() in known:
            letters += len(m[1])
        elif len(m[1]) > 3 and m[2]:
            return False
    return 2 * letters >= len(run)


# Label, string, and the characters before and behind it.
Example = tuple[int, str, str, str]


def text_examples(text: str, known: set[str]) -> Iterator[Example]:
    """Values of base spans (label 1) and runs that are surely no secret (label 0)."""
    line = narrow(text)
    runs = key_runs(line)
    base = base_within(text, line, runs)
    taken = touching((a, b) for _, a, b in base)

    def of(label: int, a: int, b: int, string: str | None = None) -> Example:
        return label, string or text[a:b], text[max(0, a - BEFORE) : a], text[b : b + AFTER]

    for kind, a, b in base:
        if kind == "assign":
            m = _ASSIGN.match(text, a)
            a, b = m.span(2) if m else (a, b)
        if b - a >= 16 and not surely_plain(text[a:b], known):
            yield of(1, a, b)
    for a, b in candidates(text, runs, base, need_digit=False):
        if surely_plain(text[a:b], known):
            yield of(0, a, b)
    # Words side by side with other marks stand for long runs that are no secrets.
    for run in long_runs(line, _LETTER_OR_BEYOND, 12):
        for m in _LONG_WORD.finditer(text, *run):
            if _even_case(m[0]) and not taken(*m.span()):
                yield of(0, *m.span())
    # So do names made of words that follow each other, with a number.
    for at in range(0, len(text), NAMES):
        # A word that starts before this place may be cut.
        words = [m.span() for m in islice(_WORD.finditer(text, at), at > 0, 4 + (at > 0))]
        if len(words) < 4 or not all(text[x:y].lower() in known for x, y in words):
            continue
        a, b = words[0][0], words[3][1]
        if b - a <= 80 and not taken(a, b):
            parts = [text[x:y] for x, y in words]
            rng = random.Random(crc32(" ".join(parts).encode()))
            yield of(0, a, b, rng.choice("-_./").join(parts) + rng.choice(["", str(rng.randrange(10000))]))


def spelled(example: Example, plain: list[Example], rng: random.Random) -> list[tuple[str, str, str]]:
    """The example as it may stand elsewhere: what is before, the string, what is behind."""
    label, string, left, right = example
    sides = [(left, right), ("", "")]
    if label:
        # A key in other characters is a key, too.
        alphabet = rng.choice(_ALPHABETS)
        other = "".join(rng.choice(alphabet) if c.isalnum() else c for c in string)
        if plain:
            # A key may stand where a plain run does, without a key word.
            sides.append(rng.choice(plain)[2:])
    else:
        other = string.upper()
    return [(before, s, behind) for s in (string, other) for before, behind in sides]


def windows_of(before: str, string: str, behind: str) -> Iterator[Parts]:
    for x, y in stretches(len(before), len(before) + len(string)):
        yield parts_of(before + string + behind, x, y)


def examples(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of a few texts, their labels and groups (one for each string and its spellings)."""
    rng = random.Random(7)
    known = known_words(texts)
    found = [e for t in texts for e in text_examples(t, known)]
    plain = [e for e in found if not e[0]]
    windows, labels, groups = [], [], []
    numbers: dict[str, int] = {}
    for example in found:
        number = numbers.setdefault(example[1].lower(), len(numbers))
        for made in spelled(example, plain, rng):
            for window in windows_of(*made):
                windows.append(window)
                labels.append(example[0])
                groups.append(number)
    return encode_all(windows), np.array(labels, dtype=np.float32), np.array(groups, dtype=np.int64)


def drawn(rows: list[Example], seed: int, most: int | None = None, batch: int = 64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Batches of one window of each example, in any order, of one spelling and stretch by chance.

    Examples of the rarer label come again until they are a quarter of the others. With ``most``
    the examples are drawn over and over, up to so many windows and 72 of each.
    """
    rng = random.Random(seed)
    labelled = [[e for e in rows if e[0] == label] for label in (0, 1)]
    few, many = sorted(labelled, key=len)
    turn = many + list(islice(cycle(few), max(len(few), len(many) // 4)))
    for _ in range(min(72, max(1, most // max(1, len(turn)))) if most else 1):
        rng.shuffle(turn)
        for at in range(0, len(turn), batch):
            part, shown = turn[at : at + batch], []
            for example in part:
                before, string, behind = rng.choice(spelled(example, labelled[0], rng))
                x, y = rng.choice(stretches(len(before), len(before) + len(string)))
                shown.append(parts_of(before + string + behind, x, y))
            yield encode_all(shown), np.array([e[0] for e in part], dtype=np.float32)


def table_words(texts: DataFrame) -> set[str]:
    """Words that two different texts use, and one in ``PAIRS`` of all pairs of a text and its word."""

    def out(counts: pa.Table) -> Iterator[pa.RecordBatch]:
        words = pc.ascii_rtrim(counts["word"].cast(pa.binary()).cast(pa.string()), "\0")
        return iter(counts.set_column(0, "word", words).to_batches())

    def count(batches):
        held: list[pa.Table] = []
        for batch in slices(batches):
            texts, hashes = batch.column("text").to_pylist(), batch.column("h").to_numpy()
            place = np.cumsum([len(t) for t in texts]) // TOGETHER
            for part in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(place)) + 1):
                held.append(counted_words([texts[i] for i in part], hashes[part]))
            if sum(c.num_rows for c in held) > 2 * HELD_WORDS:
                held = [added_up(held)]
                if held[0].num_rows > HELD_WORDS:
                    yield from out(held.pop())
        if held:
            yield from out(added_up(held))

    hashed = texts.select("text", F.xxhash64("text").alias("h"))
    counted = hashed.mapInArrow(count, "word string, n long, lo long, hi long").groupBy("word")
    words = materialise(counted.agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")), "words")
    pairs = words.agg(F.sum("n")).first()[0] or 0
    return {r.word for r in words.where((F.col("lo") < F.col("hi")) & (F.col("n") * PAIRS >= pairs)).select("word").collect()}


def table_examples(texts: DataFrame) -> DataFrame:
    """Each different example of the texts once; ``hash`` spreads them, ``held`` tells those held back."""
    known = texts.sparkSession.sparkContext.broadcast(table_words(texts))

    def find_all(batches):
        for batch in slices(batches):
            rows = [e for t in batch.column("text").to_pylist() for e in text_examples(t, known.value)]
            label, *parts = zip(*rows) if rows else ((), (), (), ())
            held = [crc32(s.lower().encode()) % FOLDS == 0 for s in parts[0]]
            columns = [pa.array(label, pa.int32()), *[pa.array(p, pa.string()) for p in parts], pa.array(held, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["label", "string", "before", "behind", "held"])

    schema = "label int, string string, before string, behind string, held boolean"
    found = texts.mapInArrow(find_all, schema).distinct()
    return materialise(found.withColumn("hash", F.xxhash64("string", "before", "behind")), "examples")


def _taught(examples: DataFrame, shard, params: dict[str, np.ndarray], rate: float, most: int | None = None):
    """Means over the shards, by their examples, of the parameters each shard comes to."""
    shapes = {k: v.shape for k, v in params.items()}

    def run(table: pa.Table) -> pa.Table:
        # A shuffle gives no order.
        rows = sorted(zip(*[table.column(c).to_pylist() for c in ("label", "string", "before", "behind")]))
        p = descend(params, drawn(rows, len(rows), most), rate)
        flat = np.concatenate([p[k].ravel() for k in shapes]).astype(np.float32).tobytes()
        return pa.table({"shard": table.column("shard")[:1], "n": [len(rows)], "params": pa.array([flat], pa.binary())})

    by_shard = examples.withColumn("shard", F.lit(shard).cast("long")).groupBy("shard")
    parts = sorted(by_shard.applyInArrow(run, "shard long, n long, params binary").collect())
    if not parts:
        return params
    mean = np.average([np.frombuffer(r.params, np.float32) for r in parts], axis=0, weights=[r.n for r in parts])
    cuts = np.cumsum([int(np.prod(s)) for s in shapes.values()])[:-1]
    return {k: v.reshape(shapes[k]).astype(np.float32) for k, v in zip(shapes, np.split(mean, cuts))}


def _held_scores(examples: DataFrame, params: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logits of the examples held back, in steps, with their labels and numbers.

    Values count in each spelling, plain runs in one; the likeliest stretch counts, as in ``find``.
    """
    net = Network(params)
    # Surroundings that do not depend on how the rows are spread.
    runs = examples.where("label = 0")
    share = F.lit(max(1, runs.count() // FIRST)).cast("long")
    plain = sorted(tuple(r) for r in runs.where(F.pmod("hash", share) == 0).select("label", "string", "before", "behind").collect())

    def run(batches):
        for batch in slices(batches):
            rows = list(zip(*[batch.column(c).to_pylist() for c in ("label", "string", "before", "behind")]))
            made = []
            for e in rows:
                rng = random.Random(crc32(e[1].encode()))
                forms = spelled(e, plain, rng)
                made += [(e[0], form) for form in (forms if e[0] else [rng.choice(forms)])]
            z = likeliest(net.logits, len(made), ((k, w) for k, (_, form) in enumerate(made) for w in windows_of(*form)))
            z = np.floor(np.clip(z, -64, 64) * STEPS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([y for y, _ in made], pa.int32()), pa.array(z)], ["label", "z"])

    counts = examples.mapInArrow(run, "label int, z int").groupBy("label", "z").count().orderBy("label", "z").collect()
    columns = np.array([(r["z"], r["label"], r["count"]) for r in counts], dtype=float).reshape(-1, 3)
    return columns[:, 0] / STEPS, columns[:, 1], columns[:, 2]


def train(documents: DataFrame) -> Network | None:
    """Network of the findings of all texts, or None if there are hardly any."""
    found = table_examples(documents.where("text IS NOT NULL").select("text"))
    taught = found.where("NOT held")
    n = {r.label: r["count"] for r in taught.groupBy("label").count().collect()}
    if n.get(1, 0) < 2 or n.get(0, 0) < 3:
        return None
    part = F.when(F.col("label") == 1, n[1] // FIRST).otherwise(n[0] // FIRST)
    few = taught.where(F.pmod("hash", F.greatest(part, F.lit(1))) == 0)
    params = _taught(few, 0, first_params(np.random.default_rng(7)), RATE, FIRST_WINDOWS)
    place = F.shiftright("hash", 20)
    shards = -(-sum(n.values()) // SHARD)
    for turn in range(ROUNDS):
        rows = taught.where(F.pmod(place, F.lit(ROUNDS)) == turn)
        params = _taught(rows, F.pmod(F.floor(place / ROUNDS), F.lit(shards)), params, LATER_RATE)
    return settled(params, *_held_scores(found.where("held"), params))


def likeliest(score: Callable[[np.ndarray], np.ndarray], n: int, windows: Iterator[tuple[int, Parts]]) -> np.ndarray:
    """The greatest score of the windows of each of ``n`` strings."""
    most = np.full(n, -np.inf)
    while part := list(islice(windows, 512)):
        np.maximum.at(most, [k for k, _ in part], score(encode_all([w for _, w in part])))
    return most


def find(texts: list[str | None], net: Network | None) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and added spans of each text; the candidates are scored together."""
    out, where = [], []
    for i, text in enumerate(texts):
        line = narrow(text or "")
        runs = key_runs(line)
        base = base_within(text, line, runs) if text else []
        out.append((base, []))
        where += [(i, a, b) for a, b in candidates(text, runs, base)] if text and net else []
    if net is None:
        return out
    parts = ((k, parts_of(texts[i], x, y)) for k, (i, a, b) in enumerate(where) for x, y in stretches(a, b))
    most = likeliest(net.probabilities, len(where), parts)
    for (i, a, b), chance in zip(where, most):
        if chance >= net.threshold:
            out[i][1].append((ADDED, a, b))
    return out


SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
        ]
    )
)


def secrets(documents: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, base (spans of the patterns) and spans (with those added), in code points."""
    from pyspark.sql.pandas.types import to_arrow_schema

    source = documents.select("doc_id", "text")
    target = T.StructType([source.schema["doc_id"], T.StructField("base", SPANS), T.StructField("spans", SPANS)])
    arrow = to_arrow_schema(target)

    def structs(spans: list[Span]) -> list[dict]:
        return [{"kind": k, "start": a, "end": b} for k, a, b in spans]

    def run(batches):
        for batch in slices(batches):
            found = find(batch.column("text").to_pylist(), net)
            base = pa.array([structs(b) for b, _ in found], arrow.field("base").type)
            spans = pa.array([structs(by_start(b + a)) for b, a in found], arrow.field("spans").type)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), base, spans], schema=arrow)

    return source.mapInArrow(run, target)
