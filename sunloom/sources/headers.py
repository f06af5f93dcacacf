"""Image headers: 80-character cards in 2880-byte blocks.

A unit's header becomes one text column, a ``KEYWORD<TAB>value`` line per card, from
which ``keyword`` picks values; all by column expressions. Python only fetches the
header bytes of stored files, so a large image is never read whole.
"""

from __future__ import annotations

import io
import os
import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunloom.functions.stages import computed_once

CARD = 80
BLOCK = 2880
# Bytes asked for at once: most headers come with the first answer of the store.
READ_AHEAD = 1 << 16
# Names that Spark gives to stores known under others.
_STORES = {None: "file", "s3a": "s3", "s3n": "s3"}
_ADDRESS = re.compile(r"(?s)^(?:([a-z][a-z0-9+.-]*):(?://([^/]*))?)?(/.*)$")


class Stores:
    """File systems by scheme and bucket, each opened once; for use inside one task."""

    def __init__(self) -> None:
        self._opened: dict = {}

    def at(self, address: str):
        """The file system of an address as Spark spells it, and the path inside it."""
        from pyarrow import fs

        found = _ADDRESS.match(address)
        if not found:
            raise ValueError(f"no absolute address: {address}")
        scheme, place = _STORES.get(found[1], found[1]), found[2] or ""
        if (scheme, place) not in self._opened:
            store, base = fs.FileSystem.from_uri(f"{scheme}://{place}/")
            self._opened[scheme, place] = store, base.rstrip("/")
        store, base = self._opened[scheme, place]
        return store, base + found[3]


def open_store(address: str):
    """The file system of one address, and the path inside it."""
    return Stores().at(address)


_END = r"(?s)^(?:.{80})*?END {77}"
_VALUE_CARD = (
    r"(?m)^(?=[^\n]{8}= )([^ \n]+) *= *(?:'((?:[^'\n]|'')*+)'[^\n]*|([^'/ \n][^/\n]*?) *(?:/[^\n]*)?)\n"
)


def _header_bytes(handle, mark: bytes) -> bytes:
    """Blocks from here through the one with the END card, if the first starts with ``mark``.

    Cards are whole within a block, so each block is looked at once; what has no
    mark, or a block that is no text, ends the header.
    """
    blocks: list[bytes] = []
    while True:
        block = handle.read(BLOCK)
        if not blocks and not block.startswith(mark):
            return block
        blocks.append(block)
        if len(block) < BLOCK or not block.isascii() or _ends(block):
            return b"".join(blocks)


def _ends(block: bytes) -> bool:
    """Whether one of a block's cards is END."""
    at = block.find(b"END")
    while at >= 0:
        if at % CARD == 0 and block[at : at + CARD].rstrip() == b"END":
            return True
        at = block.find(b"END", at + 1)
    return False


_AXES = re.compile(rb"(BITPIX|NAXIS\d*) *= *(-?\d+)")


def _data_blocks(head: bytes) -> int:
    """Blocks of pixels behind a header."""
    sizes = dict(_AXES.findall(head.rstrip()))
    if not int(sizes.get(b"NAXIS", 0)):
        return 0
    size = abs(int(sizes.get(b"BITPIX", 8))) // 8
    for i in range(1, int(sizes[b"NAXIS"]) + 1):
        size *= int(sizes.get(b"NAXIS%d" % i, 0))
    return -(-size // BLOCK)


def read_heads(stores: Stores, address: str, second: bool = True) -> tuple[bytes | None, bytes | None]:
    """Header bytes of a file's first two units; both NULL if the file is gone.

    Without ``second`` the file is not read beyond its first header.
    """
    store, key = stores.at(address)
    try:
        opened, size = _opened(store, key)
    except FileNotFoundError:
        return None, None
    with opened as handle:
        first = _header_bytes(handle, b"SIMPLE  =")
        if not second or not first.startswith(b"SIMPLE  ="):
            return first, None
        pixels = _data_blocks(first) * BLOCK
        if pixels:
            handle.seek(min(len(first) + pixels, size()))
        extension = _header_bytes(handle, b"XTENSION")
        return first, extension if extension.startswith(b"XTENSION") else None


def _opened(store, key: str):
    """A file to read, and a function that tells its size."""
    if store.type_name != "local":
        opened = store.open_input_file(key)
        return io.BufferedReader(opened, READ_AHEAD), opened.size
    number = os.open(key, os.O_RDONLY)
    try:
        start = os.read(number, READ_AHEAD)
        if len(start) < READ_AHEAD:
            os.close(number)
            return io.BytesIO(start), lambda: len(start)
        os.lseek(number, 0, os.SEEK_SET)
        return open(number, "rb", READ_AHEAD), lambda: os.fstat(number).st_size
    except OSError:
        os.close(number)
        raise


def fetch_headers(files: DataFrame, path: str = "path") -> DataFrame:
    """``(path, head0, head1)``: header bytes of the first two units, NULL if the file has none.

    The store is opened by its address (local, HDFS, S3 ...); pixels are skipped. A
    store that is not known or does not answer is an error, so the task is retried;
    a file that is gone or is no image is not.
    """

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stores = Stores()
        for batch in batches:
            heads = [read_heads(stores, address) for address in batch[path]]
            yield pd.DataFrame({"path": batch[path], "head0": [h[0] for h in heads], "head1": [h[1] for h in heads]})

    return files.select(path).mapInPandas(fetch, "path string, head0 binary, head1 binary")


def keyword(header: Column, key: str | Column) -> Column:
    """Value text of the first card of a keyword; NULL if there is none."""
    name = F.lit(key) if isinstance(key, str) else key
    line = F.regexp_substr(header, F.concat(F.lit("(?m)^"), name, F.lit("\t.*$")))
    return F.substr(line, F.length(name) + 2)


def with_keywords(units: DataFrame, header: str, keys: Sequence[str]) -> DataFrame:
    """One text column per keyword of the header column."""
    return computed_once(units, {k: keyword(F.col(header), k) for k in keys})


def _card_text(head: Column) -> Column:
    """Valued cards as lines; comments, undefined values and closing quotes undone."""
    lines = F.regexp_replace(head, "(?s)(.{80})", "$1\n")
    valued = F.regexp_replace(lines, r"(?m)^(?![^\n]{8}= *[^/ \n])[^\n]*\n", "")
    named = F.regexp_replace(valued, _VALUE_CARD, "$1\t$2$3\n")
    return F.replace(F.regexp_replace(named, "(?m) +$", ""), F.lit("''"), F.lit("'"))


def _sound(head: Column, mark: str) -> Column:
    return F.when(head.startswith(mark), _card_text(head))


def header_units(heads: DataFrame) -> DataFrame:
    """``head0`` and ``head1`` bytes to the header texts ``unit0`` and ``unit1``.

    ``unit0`` is NULL where the bytes are no image header.
    """
    texts = heads.withColumns(
        {h: F.regexp_substr(F.decode(F.col(h), "ISO-8859-1"), F.lit(_END)) for h in ("head0", "head1")}
    )
    units = computed_once(
        texts, {"unit0": _sound(F.col("head0"), "SIMPLE  ="), "unit1": _sound(F.col("head1"), "XTENSION=")}
    )
    return units.drop("head0", "head1")


def cut_units(files: DataFrame, content: str = "content") -> DataFrame:
    """``head0`` and ``head1`` bytes of whole file contents, pixels skipped."""
    measured = files.withColumn(
        "_first", F.regexp_substr(F.decode(F.col(content), "ISO-8859-1"), F.lit(_END))
    )
    # Only axes make pixels, and most headers here name none.
    header = measured.withColumn("_cards", F.when(F.col("_first").contains("NAXIS"), _card_text(F.col("_first"))))
    axes = header.withColumn("_axes", F.coalesce(keyword(F.col("_cards"), "NAXIS").try_cast("int"), F.lit(0)))
    unit = F.floor(F.abs(F.coalesce(keyword(F.col("_cards"), "BITPIX").try_cast("bigint"), F.lit(8))) / 8).cast("bigint")

    def length(i: Column) -> Column:
        key = F.concat(F.lit("NAXIS"), i.cast("string"))
        return F.coalesce(keyword(F.col("_cards"), key).try_cast("bigint"), F.lit(0).cast("bigint"))

    pixels = F.aggregate(F.sequence(F.lit(1), F.col("_axes")), unit, lambda size, i: size * length(i))
    sized = axes.withColumn("_pixels", F.when(F.col("_axes") > 0, pixels).otherwise(F.lit(0)))
    start = (F.ceil(F.length("_first") / BLOCK) + F.ceil(F.col("_pixels") / BLOCK)) * BLOCK + 1
    rest = F.substring(F.col(content), start.cast("int"), F.length(content))
    return sized.select(
        *[c for c in files.columns if c != content],
        # Through the END card; a character of the header is a byte.
        F.when(F.col("_first").isNotNull(), F.substring(F.col(content), F.lit(1), F.length("_first"))).alias("head0"),
        F.when(F.col("_first").isNotNull() & (F.length(rest) > 0), rest).alias("head1"),
    )
