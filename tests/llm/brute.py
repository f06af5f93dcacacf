"""Plain forms of the text operators, and small tables with every odd case."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Tokenizer

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, score double, row string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

ODD_TEXTS = [
    None,
    "",
    "   \n\t ",
    "!!! ... ###",
    "word",
    "Plain words of a short text.",
    "Plain words of a short text.",
    "ÉTÉ à la plage, ça va? Ünïcode ΑΣ Ελλάς 漢字 😀 x́",
    "tab\tand\x0bvertical\x1cseparator blank line \x85 end",
    "<|endoftext|> inside <|startoftext|><|ENDOFTEXT|> text",
    "a b c a b c a b c\nsame line\nsame line\n\nsame line",
    "l'été it's they'll 3.14 1,000 x_y",
    "word " * 6000,
]


def documents(spark: SparkSession, texts: list, lang: str | None = "en") -> DataFrame:
    """A table like ``documents`` with two more columns whose names clash with results."""
    rows = [(k, t, lang, None if k % 3 else "src", None if t is None else len(t), 0.5, "x") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCUMENTS)


def odd_documents(spark: SparkSession) -> DataFrame:
    """All odd texts, a repeated row and a row without an id."""
    rows = documents(spark, ODD_TEXTS)
    again = rows.where("doc_id = 5")
    nameless = rows.where("doc_id = 7").selectExpr(
        "CAST(NULL AS long) doc_id", "text", "CAST(NULL AS string) lang", "source", "n_chars", "score", "row"
    )
    return rows.unionByName(again).unionByName(nameless)


def empty_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOCUMENTS)


def benchmark(spark: SparkSession, items: list[tuple]) -> DataFrame:
    return spark.createDataFrame(items, "item_id long, text string, n_words long")


def alnum_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(text: str | None, items: list[tuple]) -> tuple:
    words, hit, found = alnum_words(text), set(), set()
    for item_id, item, *_ in items:
        target = alnum_words(item)
        if item_id is None or not target:
            continue
        size = min(13, len(target))
        for k in range(len(target) - size + 1):
            window = target[k : k + size]
            for i in range(len(words) - size + 1):
                if words[i : i + size] == window:
                    hit |= set(range(i, i + size))
                    found.add(str(item_id))
    ids = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(words), len(hit), len(found), ids, bool(hit) and 20 * len(hit) >= len(words)


def simhash(text: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fingerprints: list[tuple[int, int]], distance: int = 4) -> dict[int, int]:
    """Least id reachable, by comparing all pairs."""
    root = {i: i for i, _ in fingerprints}

    def top(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, a) in enumerate(fingerprints):
        for j, b in fingerprints[:k]:
            if (a ^ b).bit_count() <= distance:
                x, y = sorted((top(i), top(j)))
                root[y] = x
    return {i: top(i) for i, _ in fingerprints}


def tokenizer(name: str) -> Tokenizer:
    return Tokenizer.from_file(public_tokenizers.path(name))


def language(text: str | None, content: dict[str, bytes], level: int = 3, block: int = 4096) -> tuple[str, float]:
    """Language of the fewest bytes, each block compressed by a coder of its own."""
    if text is None or not any(c.isalpha() for c in text):
        return "und", 0.0
    runs = itertools.groupby(text.lower(), lambda c: re.fullmatch(r"[\W\d_]", c) is None)
    raw = "".join("".join(run) if word else " " for word, run in runs).encode()
    sizes = {}
    for lang, taught in content.items():
        sizes[lang] = 0
        book = zstandard.ZstdCompressionDict(taught, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        book.precompute_compress(level=level)
        plain = dict(write_content_size=False, write_checksum=False, write_dict_id=False)
        for at in range(0, len(raw), block):
            coder = zstandard.ZstdCompressor(level=level, dict_data=book, **plain)
            sizes[lang] += len(coder.compress(raw[at : at + block]))
    first, second = sorted(sizes.values())[:2]
    return min(sizes, key=sizes.get), min(1.0, 0.5 + 5 * (second - first) / second)


def toxicity(text: str | None, model) -> float:
    """Document score by sums over all labels of all tokens, in logarithms."""
    tokens = (text or "").split()
    if not tokens:
        return 0.0
    field = model.field
    weights = field.weights[0].astype(float)
    e = [weights[-1] + sum(weights[field.index[f]] for f in field.features(t) if f in field.index) for t in tokens]
    trans, forward, backward = field.trans.astype(float), [e[0] + field.first], [np.zeros(2)]
    for row in e[1:]:
        forward.append(row + np.logaddexp(*(forward[-1][:, None] + trans)))
    for row in reversed(e[1:]):
        backward.append(np.logaddexp(*(trans + row + backward[-1]).T))
    both = np.array(forward) + np.array(backward[::-1])
    p = 1 / (1 + np.exp(both[:, 0] - both[:, 1]))
    told, top = p[p >= 0.5], min(max(p.max(), 1e-6), 1 - 1e-6)
    x = [min(told.sum(), 3.0), 1 - np.prod(1 - told), math.log(top / (1 - top)) / 10, 1.0]
    return float(1 / (1 + math.exp(-max(-30.0, min(30.0, float(np.dot(x, model.weights)))))))


def crc(ids: list[int]) -> int:
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def personal_data(text: str | None) -> list[tuple[str, int, int]]:
    text = text or ""
    digits = lambda m: re.sub(r"[^0-9]", "", m[0])
    return [
        *(("email", *m.span()) for m in EMAIL.finditer(text)),
        *(("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))),
        *(("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and _luhn(digits(m))),
        *(("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15),
    ]


ASSIGN = re.compile(
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII
)


def secrets(text: str | None) -> list[tuple[str, int, int]]:
    text = text or ""
    found = [
        *(("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6),
        *(("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20),
        *(("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24),
    ]
    return sorted(found, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    often = {w for w in set(windows) if windows.count(w) > 1} if len(windows) < 500 else set(windows)
    repeated = {k + j for k, w in enumerate(windows) if w in often for j in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(repeated),
    )


def repeats(rows: list[tuple], window: int = 13) -> list[tuple]:
    """(doc_id, n_words, n_removed, kept text) for rows (doc_id, text)."""
    late = float("inf")
    split = [(late if k is None else k, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, t in rows]
    least: dict = {}
    for k, words in split:
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            least[key] = min(k, least.get(key, late))
    found = []
    for (k, words), (doc_id, _) in zip(split, rows):
        gone = set()
        for i in range(len(words) - window + 1):
            if least[tuple(words[i : i + window])] < k:
                gone.update(range(i, i + window))
        kept = [w for i, w in enumerate(words) if i not in gone]
        found.append((doc_id, len(words), len(gone), " ".join(kept)))
    return found


def spelling(rows: list[tuple]) -> dict[str, tuple]:
    """word to (n, n_near, form, form_n, root) for rows (doc_id, text), all pairs compared."""
    counts: dict = {}
    for k, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if k is None else k}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] = counts.get(run, 0) + 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}

    def one_apart(a: str, b: str) -> bool:
        if len(a) > len(b):
            a, b = b, a
        if len(b) - len(a) > 1 or a == b:
            return False
        k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
        return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]

    near = {w: [x for x in words if one_apart(w, x)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    found = {}
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        found[w] = (n, len(near[w]), form[w], words.get(form[w]), root)
    return found


def vector_codes(rows: list[tuple], parts: int = 8, entries: int = 16, rounds: int = 6) -> tuple[list[tuple], list]:
    """(vec_id, codes, error) of the kept rows (vec_id, vector), and the codebooks."""
    kept = []
    for k, v in rows:
        if v and all(x is not None and math.isfinite(x) for x in v):
            kept.append((k, [math.floor(4096 * x) for x in v]))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], []
    dim = len(kept[0][1]) // parts
    cut = [[v[p * dim : (p + 1) * dim] for p in range(parts)] for _, v in kept]
    books = [[list(v[p]) for v in cut[:entries]] for p in range(parts)]

    def nearest(p: int, part: list) -> tuple[int, int]:
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            groups: dict = {}
            for v in cut:
                groups.setdefault(nearest(p, v[p])[1], []).append(v[p])
            for e, own in groups.items():
                books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    found = []
    for (k, _), v in zip(kept, cut):
        best = [nearest(p, v[p]) for p in range(parts)]
        found.append((k, bytes(i for _, i in best), sum(d for d, _ in best)))
    return found, books
