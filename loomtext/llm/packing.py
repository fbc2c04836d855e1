"""Sum-of-squares online packing of documents into windows of a fixed number of tokens.

Documents come one by one. What fills whole windows is cut off; the rest goes into the fill level that leaves the least sum,
over all levels, of the squared number of windows that stand there. Only that level array and the open windows are kept, so a
task streams through its share of the documents in bounded memory, and nothing is shuffled.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

WINDOW = 2048
#: Mark at the end of each document.
END = 1
#: Rows sent on at a time, and the words a task remembers.
BATCH, REMEMBERED = 512, 300_000
#: Mean length of a word beyond which a text is not taken apart.
LONG_WORDS = 256
#: Windows of a task: sequence ids of different tasks never meet.
TASK_SEQUENCES = 1 << 40

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


#: How byte-level vocabularies write the bytes without a sign of their own: as the characters from 256 on, in order.
_HIDDEN = [*range(33), *range(127, 161), 173]
SHOWN = {b: chr(256 + i) for i, b in enumerate(_HIDDEN)}


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Remembered(dict):
    """A cache of bounded size: what was not asked for since the last but one clearing is forgotten."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key: str) -> bytes:
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


class Encoder:
    """Ids of a whole text, put together from the remembered ids of its words.

    For tokenizers that drop white space and never join across it: the ids of a text are then those of its
    space-separated words, one after the other. A Western word with a tail of signs is asked of the model in these
    two parts, which is what the tokenizer's own rules cut it into; all other words go through the tokenizer.
    """

    def __init__(self, tokenizer: str, remembered: int = REMEMBERED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.model = self.tokenizer.model
        self.words = Remembered(self._word, remembered)
        self.parts = Remembered(self._part, remembered)
        self.plain = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?%#&$*|:;()-]*)").fullmatch

    def _part(self, part: str) -> bytes:
        written = part if part.isascii() else part.encode().decode("latin-1").translate(SHOWN)
        return _packed([t.id for t in self.model.tokenize(written)])

    def _word(self, word: str) -> bytes:
        plain = self.plain(word)
        if plain:
            letters, signs = plain.groups()
            ids = self.parts[letters.lower()]
            return ids + self.parts[signs] if signs else ids
        return self._whole(word)

    def _whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def __call__(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids of the text, a null text counting as empty."""
        if not text:
            return b""
        words = text.replace("\n", " ").split(" ")
        if len(text) > LONG_WORDS * len(words):  # endless words are not worth remembering
            return self._whole(text)
        return b"".join(map(self.words.__getitem__, words))


class Packer:
    """Level array and open windows of one stream of documents."""

    def __init__(self, window: int = WINDOW, first: int = 0):
        self.window = window
        self.counts = np.zeros(window, dtype=np.int64)
        self.open: dict[int, list[list[tuple]]] = {}
        self.next = first

    def _close(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for doc, start, ids, total in pieces:
            yield doc, start, len(ids) // 4, zlib.crc32(ids), total, self.next, offset, ids
            offset += len(ids) // 4
        self.next += 1

    def level_for(self, size: int) -> int:
        """The level to fill: 0 opens a window. Of equal sums the fullest level is taken."""
        n, w = self.counts, self.window
        top = w - size
        # Change of the sum: 2 n + 1 where a window arrives, 1 - 2 n where one leaves; full windows leave the array.
        change = 1 - 2 * n[1 : top + 1]
        change[: top - 1] += 2 * n[1 + size : w] + 1
        change[n[1 : top + 1] == 0] = np.iinfo(np.int64).max
        opened = 2 * n[size] + 1
        if len(change):
            best = len(change) - 1 - int(np.argmin(change[::-1]))
            if change[best] <= opened:
                return best + 1
        return 0

    def add(self, doc, ids: bytes) -> Iterator[tuple]:
        """Place one document; yields the pieces of the windows that became full."""
        total = len(ids) // 4
        full = total - total % self.window
        for start in range(0, full, self.window):
            yield from self._close([(doc, start, ids[4 * start : 4 * (start + self.window)], total)])
        size = total - full
        if not size:
            return
        level = self.level_for(size)
        pieces = []
        if level:
            self.counts[level] -= 1
            pieces = self.open[level].pop()
        pieces.append((doc, full, ids[4 * full :], total))
        if level + size == self.window:
            yield from self._close(pieces)
        else:
            self.counts[level + size] += 1
            self.open.setdefault(level + size, []).append(pieces)

    def finish(self) -> Iterator[tuple]:
        """The windows still open: the contents of the emptiest are cut to fill the fullest, so one at most stays short."""
        rest = [pieces for level in sorted(self.open, reverse=True) for pieces in self.open[level]]
        room, current = self.window, []
        left, right = 0, len(rest)
        waiting: list[tuple] = []
        while left < right or waiting:
            if not current and left < right and not waiting:
                current, left = rest[left], left + 1
                room = self.window - sum(len(p[2]) // 4 for p in current)
                continue
            if not waiting:
                right -= 1
                waiting = rest[right][::-1]
            doc, start, ids, total = waiting.pop()
            take = min(room, len(ids) // 4)
            current.append((doc, start, ids[: 4 * take], total))
            room -= take
            if take < len(ids) // 4:
                waiting.append((doc, start + take, ids[4 * take :], total))
            if not room:
                yield from self._close(current)
                current, room = [], self.window
        if current:
            yield from self._close(current)
        self.open.clear()
        self.counts[:] = 0


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, if asked for).

    Every partition of ``docs`` is one stream, packed in its order; all of its windows but one at the end are full. A document is its tokens and the
    end mark; a null or empty text is the mark alone. Repeated rows are packed as often as they occur. Sequence ids are unique, not dense. The rows
    must come in the same order when a task is repeated, as they do from files. An empty table gives no pieces.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer = file.read()
    # The file, not the text of a document: it reaches the tasks as one broadcast of fixed size.
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)
    schema = pa.schema(
        [(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
        + ([("ids", pa.binary())] if with_ids else [])
    )

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(shared.value)
        packer = Packer(window, TaskContext.get().partitionId() * TASK_SEQUENCES)
        mark = np.array([END], dtype="<u4").tobytes()

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=False)], schema=schema)

        done: list[tuple] = []
        for arrived in batches:
            for at in range(0, arrived.num_rows, BATCH):
                part = arrived.slice(at, BATCH)
                for doc, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist(), strict=True):
                    done.extend(packer.add(doc, encode(text) + mark))
                if done:
                    yield batch(done)
                    done = []
        done.extend(packer.finish())
        if done:
            yield batch(done)

    return docs.select("doc_id", "text").mapInArrow(stream, PIECES + (", ids binary" if with_ids else ""))
