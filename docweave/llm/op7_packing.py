"""Bounded-space online packing of tokenized documents into fixed windows.

Each partition keeps at most ``open_windows`` windows.  A piece goes to the
window it fills best; when it fits none, the fullest one is emitted, after the
head of the piece has been cut off to fill it when the gap is worth a cut.
What is still open at the end of a partition is merged by whole pieces over
groups of partitions, level by level, so no task sees more than ``FAN_IN``
partitions' leftovers.

Defined cases: a null text is empty and gives the end id alone; repeated rows
and null ids are packed like any other row; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import Scratch
from docweave.llm.tokens import encoder

WINDOW = 1024
OPEN_WINDOWS = 64
#: Gaps under this many tokens are padded rather than filled by a cut.
MIN_CUT = 4
FAN_IN = 32
#: A merged window at least this full is closed below the last level.
FULL = 0.98

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, part long, open boolean")
COLUMNS = [c.split()[0] for c in PIECES.split(", ")]


class Packer:
    """The open windows of one task.  ``emit(window_id, pieces)`` gets each
    closed window; pieces are tuples that start with their length."""

    def __init__(self, size: int, windows: int, emit):
        self.size, self.limit, self.emit = size, windows, emit
        self.free: list[tuple[int, int]] = []  # (free tokens, window id), sorted
        self.held: dict[int, list] = {}
        self.next = 0

    def _new(self, pieces: list, used: int) -> None:
        if used >= self.size:
            self.emit(self.next, pieces)
        else:
            insort(self.free, (self.size - used, self.next))
            self.held[self.next] = pieces
        self.next += 1

    def fits(self, length: int) -> bool:
        return bool(self.free) and self.free[-1][0] >= length

    def place(self, length: int, piece) -> None:
        """Best fit; a new window when none fits (the fullest goes first if
        the windows are used up).  A whole window needs none of the open ones."""
        if length >= self.size:
            self._new([piece], length)
            return
        i = bisect_left(self.free, (length, -1))
        if i < len(self.free):
            gap, w = self.free.pop(i)
            self.held[w].append(piece)
            if gap == length:
                self.emit(w, self.held.pop(w))
            else:
                insort(self.free, (gap - length, w))
            return
        if len(self.free) >= self.limit:
            self.close_fullest()
        self._new([piece], length)

    def fullest_gap(self) -> int:
        return self.free[0][0] if len(self.free) >= self.limit else 0

    def fill_fullest(self, piece) -> None:
        """``piece`` is exactly as long as the gap of the fullest window."""
        _, w = self.free.pop(0)
        self.emit(w, [*self.held.pop(w), piece])

    def close_fullest(self) -> None:
        _, w = self.free.pop(0)
        self.emit(w, self.held.pop(w))


def _rows(pieces: list, sequence: int, part: int, is_open: bool, out: list) -> None:
    offset = 0
    for p in pieces:
        out.append((p[1], p[2], p[0], p[3], p[4], sequence, offset, part, is_open))
        offset += p[0]


def _frame(rows: list) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=COLUMNS)
    out["doc_id"] = pd.array(out["doc_id"], "Int64")
    return out


def pack_partitions(docs: DataFrame, tokenizer: str, end_id: int, size: int = WINDOW,
                    windows: int = OPEN_WINDOWS, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The pieces of each partition's own pass, with those of still open windows marked."""
    end = int(end_id).to_bytes(4, "little")

    def pack(batches):
        part, enc, out = TaskContext.get().partitionId(), encoder(tokenizer), []
        base = part << 32
        packer = Packer(size, windows, lambda w, pieces: _rows(pieces, base + w, part, False, out))
        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["__text"]):
                doc = None if pd.isna(doc) else int(doc)
                ids = enc.encode(text) + end
                total, at = len(ids) // 4, 0

                def piece(n):
                    return (n, doc, at, zlib.crc32(ids[4 * at:4 * (at + n)]), total)

                while at < total:
                    left = total - at
                    n = min(left, size)
                    gap = 0 if left >= size or packer.fits(left) else packer.fullest_gap()
                    if MIN_CUT <= gap < left:
                        n = gap
                        packer.fill_fullest(piece(n))
                    else:
                        packer.place(n, piece(n))
                    at += n
                if len(out) > 20_000:
                    yield _frame(out)
                    out.clear()
        for _, w in packer.free:
            _rows(packer.held[w], base + w, part, True, out)
        yield _frame(out)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("__text"))
    return rows.mapInPandas(pack, PIECES)


def _merge_level(level: int, last: bool, size: int, windows: int):
    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        group = int(frame["part"].iloc[0]) // FAN_IN
        base, out = (level << 58) + (group << 32), []
        closed = []
        packer = Packer(size, len(frame) + 1, lambda w, pieces: closed.append((w, pieces)))
        frame = frame.sort_values(["length", "sequence_id", "offset"], ascending=[False, True, True])
        for p in zip(frame["length"], frame["doc_id"], frame["start"], frame["ids_crc32"], frame["doc_tokens"]):
            packer.place(int(p[0]), p)
        for w, pieces in closed:
            _rows(pieces, base + w, group, False, out)
        keep = 0
        for gap, w in reversed(packer.free):  # emptiest first
            stays = not last and keep < windows and gap > (1 - FULL) * size
            keep += stays
            _rows(packer.held[w], base + w, group, stays, out)
        return _frame(out)

    return merge


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, size: int = WINDOW,
                   windows: int = OPEN_WINDOWS, **columns) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.  Writes the pieces once, then merges leftovers."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    level = scratch.save(pack_partitions(docs, tokenizer, end_id, size, windows, **columns), "level0")
    done = level.filter(~F.col("open"))
    parts = level.agg(F.max("part")).first()[0]
    k = 1
    while parts is not None:
        last = parts < FAN_IN
        merged = (level.filter("open").groupBy(F.floor(F.col("part") / FAN_IN).alias("__group"))
                  .applyInPandas(_merge_level(k, last, size, windows), PIECES))
        level = scratch.save(merged, f"level{k}")
        done = done.unionByName(level.filter(~F.col("open")))
        if last:
            break
        parts, k = parts // FAN_IN, k + 1
    return done.drop("part", "open")
