"""Personal data: fixed patterns, and a conditional random field that adds spans.

The patterns give the base spans of each kind. A linear-chain field over the shapes of words
and of their neighbours learns from a small labelled table: token chains of a bounded sample
of texts, labelled by the base spans, phone numbers also without their country code. It is
decoded by Viterbi over every token of every text. Runs of one label are cut at base spans,
line ends and closing punctuation, and where they hold several numbers or addresses in a row;
each plausible part is added.

Results in odd cases: a null or empty text has no spans; repeated rows get a row each; with
an empty table or no personal data in the sample the field adds nothing; other columns are
not read, or kept as they are by ``redact``. The patterns cost time in proportion to the
text: each character is looked at a bounded number of times.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunloom.functions.stages import computed_once
from sunloom.llm.common import bounded_sample, slices, spread_text, touching
from sunloom.llm.crf import Chain, Decoder

KINDS = ("email", "ip", "card", "phone")
LABELS = ("other", *KINDS)
PHONE = LABELS.index("phone")
# At most so many texts with digits or at-signs teach, and as many others of a quarter.
SAMPLE_TEXTS = 1200
SAMPLE_CHARS = 4000
# Tokens on each side of a labelled or digit-bearing one in a chain, and chains at most.
BESIDE, CHAINS = 5, 3000

Span = tuple[str, int, int]

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_NUMBERS = re.compile(r"[0-9]+(?:[.\x20-][0-9]+)*")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_TOKEN = re.compile(r"\S+")


def luhn(digits: str) -> bool:
    values = np.frombuffer(digits.encode(), dtype=np.uint8)[::-1].astype(np.int64) - 48
    values[1::2] *= 2
    return int((values - 9 * (values > 9)).sum()) % 10 == 0


def _emails(text: str):
    """Leftmost matches: what stands before an at-sign can only be the run that reaches it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            yield "email", start, match.end()
        done = match.end() if match else at + 1
        at = text.find("@", done)


def _octets(groups: list[str]) -> bool:
    return all(len(g.lstrip("0")) <= 3 and int(g.lstrip("0") or 0) <= 255 for g in groups)


def _addresses(text: str, start: int, end: int):
    """Leftmost matches of four dotted groups: each takes four whole groups, so they are counted off."""
    for m in _DOTTED.finditer(text, start, end):
        groups, at = m[0].split("."), m.start()
        for k in range(0, len(groups) - 3, 4):
            four = groups[k : k + 4]
            size = sum(map(len, four)) + 3
            if _octets(four):
                yield "ip", at, at + size
            at += size + 1


def base_spans(text: str | None) -> list[Span]:
    """Spans of the fixed patterns, by kind as listed, then by start."""
    if not text:
        return []
    ips, cards = [], []
    # Both patterns lie within digits joined by single separators.
    for run in _NUMBERS.finditer(text):
        if run.end() - run.start() < 7:
            continue
        ips += _addresses(text, *run.span())
        if run.end() - run.start() >= 16:
            for m in _CARD.finditer(text, *run.span()):
                digits = _NOT_DIGIT.sub("", m[0])
                if 16 <= len(digits) <= 19 and luhn(digits):
                    cards.append(("card", *m.span()))
    phones = [
        ("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15
    ]
    return [*_emails(text), *ips, *cards, *phones]


def _shape(word: str) -> str:
    """A for capitals, a for other letters, 0 for digits, the rest as it is; runs once."""
    out = []
    for c in word:
        kind = "0" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out)


def features(word: str) -> list[str]:
    """Of a word's shape only, so words never seen are judged like those that were."""
    if word.isalpha():
        return ["alpha", f"n={min(len(word), 6)}"]
    bare = word.strip(".,;:!?()[]\"'|")
    digits = _NOT_DIGIT.sub("", bare)
    found = [f"shape={_shape(bare)}", f"digits={min(len(digits), 20)}"]
    if "@" in bare[1:]:
        found.append("at")
    if bare.startswith("+"):
        found.append("plus")
    if digits and len(digits) == len(bare):
        found.append("number")
        if 16 <= len(digits) <= 19:
            found.append(f"luhn={luhn(digits)}")
    parts = bare.split(".")
    if len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 for p in parts):
        found.append(f"octets={all(int(p) <= 255 for p in parts)}")
    if word != bare:
        found.append(f"edge={word[-1]}" if word[-1:] != bare[-1:] else "front")
    return found


def labelled_chains(texts: list[str], most: int = CHAINS) -> list[tuple[list[str], list[int]]]:
    """Token chains of texts with the kind of the base span that covers each token."""
    chains = []
    for text in texts:
        tokens = [(m[0], *m.span()) for m in _TOKEN.finditer(text)]
        spans = sorted(((a, b, LABELS.index(k)) for k, a, b in base_spans(text)))
        labels = [0] * len(tokens)
        starts = np.array([a for _, a, _ in tokens])
        ends = np.array([b for _, _, b in tokens])
        for a, b, label in spans:
            for i in range(int(np.searchsorted(ends, a, side="right")), int(np.searchsorted(starts, b))):
                labels[i] = label
        wanted = [i for i, (w, _, _) in enumerate(tokens) if labels[i] or not w.isalpha() and _has_digit(w)]
        end = 0
        for i in wanted or range(0, min(len(tokens), 1)):
            if i >= end:
                start, end = max(0, i - BESIDE), i + BESIDE + 1
                words, kinds = [w for w, _, _ in tokens[start:end]], labels[start:end]
                chains.append((words, kinds))
                # The same without the country code of a phone number.
                kept = [k for k, w in enumerate(words) if not (kinds[k] == PHONE and w[0] == "+")]
                if len(kept) < len(words) and any(kinds[k] == PHONE for k in kept):
                    chains.append(([words[k] for k in kept], [kinds[k] for k in kept]))
    return chains[:: max(1, -(-len(chains) // most))]


def _has_digit(word: str) -> bool:
    return any("0" <= c <= "9" for c in word)


def train(documents: DataFrame) -> Chain:
    """Fit the field to a bounded sample of the table."""
    whole = documents.where("text IS NOT NULL").select(F.col("text").alias("_whole"))
    texts = computed_once(whole, {"text": spread_text("_whole", SAMPLE_CHARS)}).select("text")
    bearing = bounded_sample(texts.where("text RLIKE '[0-9][0-9. -]{5}|@'"), None, ["text"], F.col("text"), SAMPLE_TEXTS)
    others = bounded_sample(texts, None, ["text"], F.col("text"), SAMPLE_TEXTS // 4)
    rows = sorted({r.text for r in bearing.unionByName(others).collect()})
    return Chain(LABELS, features).fit(labelled_chains(rows), rounds=60)


def added_spans(text: str, labels: np.ndarray, base: list[Span]) -> list[Span]:
    """Plausible parts of runs of one label beside base spans, without punctuation around them."""
    if not labels.any():
        return []
    taken = touching((a, b) for _, a, b in base)
    covered = sorted((a, b) for _, a, b in base)
    out: list[Span] = []
    run: list[tuple[int, int]] = []
    kind = 0

    def close() -> None:
        if not run:
            return
        a, b = run[0][0], run[-1][1]
        for stretch in _outside(a, b, covered if taken(a, b) else []):
            parts = [part for line in _cut(text, *stretch, _LINE_END) for part in _parts(kind, text, *line)]
            whole = _trimmed(text, *stretch)
            # A number over a line end or a comma, of which parts would leave digits.
            if _plausible(kind, text[slice(*whole)]) and (
                not parts or sum(_digits(text, *p) for p in parts) < _digits(text, *whole)
            ):
                parts = [whole]
            out.extend((LABELS[kind], *part) for part in parts)

    for i, m in enumerate(_TOKEN.finditer(text)):
        label = int(labels[i])
        if label != kind:
            close()
            run, kind = [], label
        if label:
            run.append(m.span())
    close()
    return out


_LINE_END = re.compile(r"[\n\r\v\f\x1c-\x1e\x85\u2028\u2029]+")
# What closes a number or an address, and blanks before a country code.
_CLOSING = re.compile(r"[,;:!?|\"]+|\.(?=\s|$)|\s+(?=\+)")
_DIGITS = {"card": (16, 19), "phone": (7, 15)}


def _outside(a: int, b: int, covered: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Parts of a stretch outside sorted spans."""
    out = []
    for x, y in covered[max(0, bisect_left(covered, (a, a)) - 1) :] if covered else []:
        if x >= b:
            break
        if x > a:
            out.append((a, x))
        a = max(a, y)
    return [*out, (a, b)] if a < b else out


def _cut(text: str, a: int, b: int, at: re.Pattern) -> list[tuple[int, int]]:
    out = []
    for m in at.finditer(text, a, b):
        if m.start() > a:
            out.append((a, m.start()))
        a = m.end()
    return [*out, (a, b)] if a < b else out


def _digits(text: str, a: int, b: int) -> int:
    return len(_NOT_DIGIT.sub("", text[a:b]))


def _trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    while a < b and not text[a].isalnum() and text[a] not in "+(":
        a += 1
    while b > a and not text[b - 1].isalnum():
        b -= 1
    return a, b


def _parts(kind: int, text: str, a: int, b: int) -> list[tuple[int, int]]:
    """Plausible spans of a line's run: parts between closing punctuation, and groups of what
    lies between such parts, where the punctuation is within a number."""
    out: list[tuple[int, int]] = []
    left: list[tuple[int, int]] = []

    def settle() -> None:
        if len(left) > 1:
            out.extend(_groups(kind, text, left))
        left.clear()

    for part in _cut(text, a, b, _CLOSING):
        found = _row(kind, text, *part)
        if found:
            settle()
            out.extend(found)
        else:
            left.append(part)
    settle()
    return out


def _row(kind: int, text: str, a: int, b: int) -> list[tuple[int, int]]:
    """The stretch if plausible, or the plausible spans of its tokens that stand in a row."""
    a, b = _trimmed(text, a, b)
    name = LABELS[kind]
    tokens = [m.span() for m in _TOKEN.finditer(text, a, b)]
    if name in ("email", "ip"):
        each = [_trimmed(text, *t) for t in tokens]
        good = [t for t in each if _plausible(kind, text[slice(*t)])]
        if len(good) > 1:
            return good
    if _plausible(kind, text[a:b]):
        return [(a, b)]
    return _groups(kind, text, tokens)


def _groups(kind: int, text: str, units: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Plausible groups of consecutive units: those that cover most digits, of like length if
    there is a choice."""
    if LABELS[kind] not in _DIGITS:
        return []
    least, most = _DIGITS[LABELS[kind]]
    counted = [(x, y, n) for x, y in units if (n := _digits(text, x, y))]
    # Best (digits covered, less their squares) of the tokens so far, and the group that ends there.
    best: list[tuple[int, int]] = [(0, 0)]
    taken: list[int] = []
    for j in range(len(counted)):
        top, start, n = best[j], -1, 0
        for i in range(j, -1, -1):
            n += counted[i][2]
            if n > most:
                break
            if n >= least and _plausible(kind, text[counted[i][0] : counted[j][1]]):
                value = (best[i][0] + n, best[i][1] - n * n)
                if value > top:
                    top, start = value, i
        best.append(top)
        taken.append(start)
    out, j = [], len(counted) - 1
    while j >= 0:
        i = taken[j]
        if i >= 0:
            out.append(_trimmed(text, counted[i][0], counted[j][1]))
        j = i - 1 if i >= 0 else j - 1
    return out[::-1]


def _plausible(kind: int, found: str) -> bool:
    """What a span of the kind has in any spelling."""
    n = len(_NOT_DIGIT.sub("", found))
    name = LABELS[kind]
    if name == "email":
        return "@" in found
    if name == "ip":
        groups = re.findall("[0-9]+", found)
        return len(groups) == 4 and _octets(groups)
    least, most = _DIGITS[name]
    return least <= n <= most and (name != "card" or luhn(_NOT_DIGIT.sub("", found)))


def find(texts: list[str | None], decoder: Decoder) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and added spans of each text."""
    labels = decoder.best([t.split() if t else [] for t in texts])
    out = []
    for text, found in zip(texts, labels):
        base = base_spans(text)
        out.append((base, added_spans(text, found, base) if text else []))
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


def _structs(spans: list[Span]) -> list[dict]:
    return [{"kind": k, "start": a, "end": b} for k, a, b in spans]


def by_kind(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))


def personal_data(documents: DataFrame, field: Chain) -> DataFrame:
    """doc_id, base (spans of the patterns) and spans (with those added), in code points."""
    from pyspark.sql.pandas.types import to_arrow_schema

    source = documents.select("doc_id", "text")
    target = T.StructType([source.schema["doc_id"], T.StructField("base", SPANS), T.StructField("spans", SPANS)])
    arrow = to_arrow_schema(target)

    def run(batches):
        decoder = Decoder(field)
        for batch in slices(batches):
            found = find(batch.column("text").to_pylist(), decoder)
            base = pa.array([_structs(b) for b, _ in found], arrow.field("base").type)
            spans = pa.array([_structs(by_kind(b + a)) for b, a in found], arrow.field("spans").type)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), base, spans], schema=arrow)

    return source.mapInArrow(run, target)


def mask(text: str | None, spans: list[Span]) -> str | None:
    """The text with each span, or run of overlapping spans, replaced by its kind in brackets."""
    if not spans:
        return text
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"<{kind.upper()}>"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def redact(documents: DataFrame, field: Chain) -> DataFrame:
    """The rows with personal data masked in ``text``, and ``n_chars`` (if any) counted anew."""
    names = documents.columns
    counted = "n_chars" in names and isinstance(documents.schema["n_chars"].dataType, (T.LongType, T.IntegerType))

    def run(batches):
        decoder = Decoder(field)
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            masked = [mask(t, b + a) for t, (b, a) in zip(texts, find(texts, decoder))]
            columns = list(batch.columns)
            at = names.index("text")
            columns[at] = pa.array(masked, batch.schema.field("text").type)
            if counted:
                at = names.index("n_chars")
                old = batch.column("n_chars").to_pylist()
                new = [n if t == m else len(m) for n, t, m in zip(old, texts, masked)]
                columns[at] = pa.array(new, batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return documents.mapInArrow(run, documents.schema)
