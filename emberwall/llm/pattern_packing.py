"""Packing token sequences by length patterns, fitted by non-negative least squares.

Documents are cut into pieces of at most ``limit`` tokens. Only the histogram of
piece lengths, at most ``limit`` numbers, is planned with on the driver:

1. Lengths are rounded up to 1/128 of the limit. Every way to fill a sequence
   exactly with two to four rounded lengths is a pattern.
2. Non-negative least squares finds how often each pattern repeats so that all
   together use up the histogram; the counts are rounded down.
3. Each repeat takes real lengths of its classes, the last one the best fit for
   what is left. What no pattern used is packed best fit, longest first, into the
   room that is left and then into new sequences.

The plan is a list of runs: the ``m`` pieces of one length from rank ``r`` on go to
``m`` sequences from number ``s`` on, at one offset. A piece finds its place by its
rank among the pieces of its length, which is counted without ordering the pieces.

Null and empty texts have one token, the end; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberwall.llm.common import (
    Rows,
    column_bytes,
    map_batches,
    shuffle_parts,
    worker_memory,
    write_bucketed,
)
from emberwall.session import store

CLASSES = 128
MOST_PARTS = 4
#: Names of the columns that packing adds, some of them only on the way.
RESULTS = {
    "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset", "part", "place",
    "_before", "_n", "_lengths", "_befores", "_lists",
}
#: Words, and runs of letters, a worker remembers before the oldest of them go. It holds up
#: to twice as many: those met since the last time, and those before that.
REMEMBERED, REMEMBERED_RUNS = 250_000, 150_000
#: Words split or given to the library at a time.
AT_ONCE = 1000
#: Bytes of text whose different words are looked up together; this takes some 15 times as
#: much memory.
BYTES_AT_ONCE = 4 << 20


# --- tokens -------------------------------------------------------------------


class Generations:
    """A dictionary that gives up what has not been asked for lately: values met since the
    young generation was started are in it; when it is full, it takes the place of the old
    one. What is asked for again moves to the young one, so frequent keys stay."""

    def __init__(self, most: int):
        self.most = most
        self.young: dict = {}
        self.old: dict = {}

    def turn(self) -> None:
        if len(self.young) > self.most:
            self.old, self.young = self.young, {}

    def missing(self, keys: Iterable) -> set:
        """The keys that are not known; the others are in the young generation then."""
        unknown = set(keys).difference(self.young)
        again = self.old.keys() & unknown
        self.young.update(zip(again, map(self.old.__getitem__, again)))
        return unknown - again

    def find(self, keys: list) -> tuple[list, list[int]]:
        """The values of the keys, None if not known, and the places of those. Known keys
        are in the young generation then."""
        values, unknown = list(map(self.young.get, keys)), []
        for i in [i for i, value in enumerate(values) if value is None]:
            value = self.old.get(keys[i])
            if value is None:
                unknown.append(i)
            else:
                self.young[keys[i]] = values[i] = value
        return values, unknown


def plain_words():
    """What matches lines of plain words, and what splits those, in lower case, as the
    vocabulary's tokenizer does: into runs of letters, single digits and runs of other
    signs. Plain are printable ASCII and Latin letters that lower case leaves single."""
    chars = [chr(c) for c in range(0x21, 0x180) if not 0x7F <= c <= 0xA0 and c != 0x130]
    of: dict[str, str] = defaultdict(str)
    for c in chars:
        kind = unicodedata.category(c)[0]
        of[kind if kind in "LN" else "other"] += re.escape(c)
    # Endings that the tokenizer takes as one.
    endings = r"'s|'t|'re|'ve|'m|'ll|'d"
    split = re.compile(rf"\n|{endings}|[{of['L']}]+|[{of['N']}]|[{of['other']}]+")
    return re.compile(f"[{''.join(map(re.escape, chars))}\n]+").fullmatch, split.findall


class Encoder:
    """Ids of whole texts. The tokenizer drops white space and never joins across
    it, so a text is the sequence of its words. The different words of some texts are
    looked up once, and remembered; so is the library's tokenizer.

    A word of Latin letters without marks to compose is the sequence of its runs of
    letters, single digits and runs of other signs, so different runs are given to the
    library, many at a time; other words are given to it one by one.
    """

    def __init__(self, definition: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.plain, self.runs_of = plain_words()
        # for these definitions only, so that another vocabulary starts anew
        memory = worker_memory(f"packing {zlib.crc32(definition.encode())}")
        if "tokenizer" not in memory:
            memory["tokenizer"] = Tokenizer.from_str(definition)
        self.tokenizer = memory["tokenizer"]
        self.words = memory.setdefault("words", Generations(REMEMBERED))
        self.runs = memory.setdefault("runs", Generations(REMEMBERED_RUNS))
        # Whether an id ends a run: the vocabulary marks the last piece of each.
        if "ends" not in memory:
            mark = self.tokenizer.model.end_of_word_suffix
            vocabulary = self.tokenizer.get_vocab()
            memory["ends"] = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
            memory["ends"][[i for t, i in vocabulary.items() if mark and t.endswith(mark)]] = True
        self.ends = memory["ends"]

    def _learn_runs(self, runs: list[str]) -> None:
        """Give different runs to the library in one text and cut the ids where runs end."""
        encoded = self.tokenizer.encode_batch_fast([" ".join(runs)], add_special_tokens=False)
        ids = np.array(encoded[0].ids, "<u4")
        ends = (np.flatnonzero(self.ends[ids]) + 1).tolist()
        young = self.runs.young
        if len(ends) == len(runs) and ends[-1] == len(ids):
            raw = ids.tobytes()
            for run, begin, end in zip(runs, [0, *ends], ends):
                young[run] = raw[4 * begin : 4 * end]
            return
        for run, e in zip(runs, self.tokenizer.encode_batch_fast(runs, add_special_tokens=False)):
            young[run] = np.array(e.ids, "<u4").tobytes()

    def learn(self, words: list[bytes]) -> None:
        other: list[bytes] = []
        for k in range(0, len(words), AT_ONCE):
            group = words[k : k + AT_ONCE]
            shown = b"\n".join(group).decode("utf-8", "replace")
            if not self._is_plain(shown):
                each = [w.decode("utf-8", "replace") for w in group]
                other += [w for w, x in zip(group, each) if not self._is_plain(x)]
                kept = [(w, x) for w, x in zip(group, each) if self._is_plain(x)]
                group, shown = [w for w, _ in kept], "\n".join([x for _, x in kept])
            if group:
                self._learn_plain(group, self.runs_of(shown.lower()))
        for k in range(0, len(other), AT_ONCE):
            group = other[k : k + AT_ONCE]
            shown = [x.decode("utf-8", "replace") for x in group]
            for word, e in zip(group, self.tokenizer.encode_batch_fast(shown, add_special_tokens=False)):
                self.words.young[word] = np.array(e.ids, "<u4").tobytes()

    def _is_plain(self, shown: str) -> bool:
        return self.plain(shown) is not None and "<|" not in shown

    def _learn_plain(self, words: list[bytes], split: list[str]) -> None:
        """``split`` are the runs of the words, with line ends between words."""
        self.runs.turn()
        unknown = self.runs.missing(split)
        unknown.discard("\n")
        if unknown:
            self._learn_runs(list(unknown))
        known, get = self.words.young, self.runs.young.__getitem__
        split.append("\n")
        begin = 0
        for word in words:
            end = split.index("\n", begin)
            known[word] = b"".join(map(get, split[begin:end]))
            begin = end + 1

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids as little-endian unsigned 32-bit numbers."""
        # No check of UTF-8 here: white space is ASCII, and words are only bytes.
        lists = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).view(pa.string()))
        coded = lists.values.view(pa.binary()).dictionary_encode()
        parts = self._ids_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        starts, pool = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(parts), "<u4")
        # the ids of every word, one after another
        at = coded.indices.to_numpy()
        counts = sizes[at]
        ends = np.concatenate([[0], np.cumsum(counts)])
        ids = pool[np.arange(ends[-1]) + np.repeat(starts[at] - ends[:-1], counts)].tobytes()
        bounds = (4 * ends[lists.offsets.to_numpy()]).tolist()
        return [ids[begin:end] for begin, end in zip(bounds, bounds[1:])]

    def _ids_of(self, words: list[bytes]) -> list[bytes]:
        """The ids of different words."""
        self.words.turn()
        parts, unknown = self.words.find(words)
        if unknown:
            missing = [words[i] for i in unknown]
            self.learn(missing)
            for i, part in zip(unknown, map(self.words.young.__getitem__, missing)):
                parts[i] = part
        return parts


def groups_of(texts: list[bytes], size: int) -> Iterator[tuple[int, list[bytes]]]:
    """The texts in turn, about ``size`` bytes at a time (a longer text alone), each group
    with the place of its first."""
    first = held = 0
    for i, text in enumerate(texts):
        if i > first and held + len(text) > size:
            yield first, texts[first:i]
            first, held = i, 0
        held += len(text)
    if texts:
        yield first, texts[first:]


def pieces_of(
    docs: DataFrame,
    tokenizer_path: str,
    text: str = "text",
    keep: Sequence[str] | None = None,
    limit: int = 4096,
    end_id: int = 1,
    with_ids: bool = True,
    bytes_at_once: int = BYTES_AT_ONCE,
) -> DataFrame:
    """One row per piece: the columns ``keep`` of ``docs`` (default all whose names
    are free), then ``piece``, ``start``, ``length``, ``ids_crc32`` and, if wanted,
    ``ids``; and ``part`` and ``place``, a number of the piece among those of its
    length in its part."""
    at = docs.columns.index(text)
    if keep is None:
        keep = [c for c in docs.columns if c.lower() not in RESULTS]
    elif clash := RESULTS & {c.lower() for c in keep}:
        raise ValueError(f"columns named like results can't be kept: {sorted(clash)}")
    kept = [docs.columns.index(c) for c in keep]
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())
    fields = "piece int, start long, length long, ids_crc32 long, part int, place long"
    if with_ids:
        fields += ", ids array<int>"
    own = T.StructType.fromDDL(fields)
    schema = T.StructType([*[docs.schema[i] for i in kept], *own.fields])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Rows) -> Rows:
        from pyspark import TaskContext

        encoder, part = Encoder(definition.value), TaskContext.get().partitionId()
        counts = np.zeros(limit + 1, np.int64)
        for batch in batches:
            texts = column_bytes(batch.column(at))
            for first, group in groups_of(texts, bytes_at_once):
                owner, piece, start, length, crc, place, ids = [], [], [], [], [], [], []
                for i, encoded in enumerate(encoder.encode(group)):
                    encoded += end
                    for k, begin in enumerate(range(0, len(encoded), 4 * limit)):
                        body = encoded[begin : begin + 4 * limit]
                        n = len(body) // 4
                        owner.append(first + i)
                        piece.append(k)
                        start.append(begin // 4)
                        length.append(n)
                        crc.append(zlib.crc32(body))
                        place.append(int(counts[n]))
                        counts[n] += 1
                        if with_ids:
                            ids.append(np.frombuffer(body, "<i4"))
                rows = pa.array(owner, pa.int64())
                columns = [batch.column(i).take(rows) for i in kept] + [
                    pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                    pa.array([part] * len(piece), pa.int32()), pa.array(place, pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return map_batches(docs, run, schema)


# --- the plan -----------------------------------------------------------------


def patterns(total: int, most: int) -> np.ndarray:
    """All ways to write ``total`` as a sum of two to ``most`` whole numbers, as
    columns of counts per number (row 0 is the number 1)."""
    found: list[tuple[int, ...]] = []

    def extend(parts: tuple[int, ...], left: int) -> None:
        if parts and left <= parts[-1]:
            found.append((*parts, left))
        if len(parts) < most - 1:
            top = min(parts[-1] if parts else total - 1, left - 1)
            # the parts still to come must be able to fill what is left
            low = -(-left // (most - len(parts)))
            for part in range(top, low - 1, -1):
                extend((*parts, part), left - part)

    extend((), total)
    out = np.zeros((total, len(found)), np.float64)
    for column, parts in enumerate(found):
        for part in parts:
            out[part - 1, column] += 1
    return out


def fit_nonnegative(
    a: np.ndarray, b: np.ndarray, small: float = 1e-9, rounds: int = 4 * CLASSES
) -> np.ndarray:
    """Least squares ``a x = b`` with ``x >= 0`` by an active set: the column that
    helps most joins, columns that would turn negative leave. It ends when no
    column has a gradient above ``small``, or after ``rounds``."""
    x = np.zeros(a.shape[1])
    active = np.zeros(a.shape[1], bool)
    for _ in range(rounds):
        gain = a.T @ (b - a @ x)
        gain[active] = -np.inf
        best = int(np.argmax(gain))
        if gain[best] <= small:
            break
        active[best] = True
        while True:
            at = np.flatnonzero(active)
            z = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if (z > 0).all():
                x[:] = 0
                x[at] = z
                break
            low = z <= 0
            step = x[at][low] / np.maximum(x[at][low] - z[low], 1e-300)
            x[at] += step.min(initial=1.0) * (z - x[at])
            x[at[x[at] <= 1e-12 * max(b.max(), 1.0)]] = 0
            active[at[low & (x[at] <= 0)]] = False
            if not active.any():
                break
    return x


class Plan:
    """Runs of (length, first rank, copies, first sequence, offset)."""

    def __init__(self, histogram: np.ndarray):
        self.limit = len(histogram) - 1
        self.left = histogram.astype(np.int64).copy()
        self.used = np.zeros(len(histogram), np.int64)
        self.runs: list[tuple[int, int, int, int, int]] = []
        self.sequences = 0
        self.room: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.open = np.zeros(self.limit + 1, bool)

    def put(self, length: int, copies: int, sequence: int, offset: int) -> None:
        self.runs.append((length, int(self.used[length]), copies, sequence, offset))
        self.used[length] += copies
        self.left[length] -= copies

    def new(self, lengths: Sequence[int], copies: int) -> None:
        offset = 0
        for length in lengths:
            self.put(length, copies, self.sequences, offset)
            offset += length
        self.leave(self.limit - offset, self.sequences, copies)
        self.sequences += copies

    def leave(self, room: int, sequence: int, copies: int) -> None:
        if room and copies:
            self.room[room].append((sequence, copies))
            self.open[room] = True

    def repeat(self, bounds: list[tuple[int, int]], copies: int) -> None:
        """Repeat a pattern whose parts have lengths within the bounds, while
        there are such lengths."""
        while copies > 0:
            taken: list[int] = []
            free = self.left.copy()
            room = self.limit
            for i, (low, high) in enumerate(bounds):
                if i == len(bounds) - 1:
                    high = room  # best fit for what is left
                fits = np.flatnonzero(free[low : min(high, room) + 1] > 0)
                if not len(fits):
                    return
                length = low + int(fits[-1])
                taken.append(length)
                free[length] -= 1
                room -= length
            times = min(int(self.left[x]) // taken.count(x) for x in taken)
            times = min(times, copies)
            self.new(taken, times)
            copies -= times

    def best_fit(self) -> None:
        """Place all that is left, longest first, where the least room remains."""
        for length in range(self.limit, 0, -1):
            while self.left[length]:
                rooms = np.flatnonzero(self.open[length:])
                if len(rooms):
                    room = length + int(rooms[0])
                    sequence, copies = self.room[room].pop()
                    self.open[room] = bool(self.room[room])
                    times = min(copies, int(self.left[length]))
                    self.put(length, times, sequence, self.limit - room)
                    self.leave(room - length, sequence, times)
                    self.leave(room, sequence + times, copies - times)
                else:
                    each = min(self.limit // length, int(self.left[length]))
                    self.new([length] * each, int(self.left[length]) // each)


def make_plan(histogram: np.ndarray) -> Plan:
    """``histogram[n]`` is how many pieces have ``n`` tokens."""
    plan = Plan(histogram)
    limit = plan.limit
    plan.new([limit], int(plan.left[limit]))
    classes = min(CLASSES, limit)
    size = -(-limit // classes)
    classes = limit // size
    of_class = np.zeros(classes)
    lengths = np.arange(1, classes * size + 1)
    np.add.at(of_class, (lengths - 1) // size, plan.left[1 : classes * size + 1])
    if classes > 1 and of_class.sum():
        columns = patterns(classes, MOST_PARTS)
        # repeats are whole numbers, so a gradient below half a piece is nothing
        times = np.floor(fit_nonnegative(columns, of_class, small=0.5) + 1e-6).astype(np.int64)
        for k in np.argsort(-times, kind="stable"):
            if not times[k]:
                break
            parts = np.repeat(np.arange(classes, 0, -1), columns[::-1, k].astype(int))
            plan.repeat([((c - 1) * size + 1, c * size) for c in parts.tolist()], int(times[k]))
    plan.best_fit()
    return plan


# --- the operator -------------------------------------------------------------


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    text: str = "text",
    keep: Sequence[str] | None = None,
    limit: int = 4096,
    end_id: int = 1,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: the columns ``keep`` of ``docs`` (default all but those named
    like a result), ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``,
    ``offset`` and, if wanted, ``ids``.

    Tokens are made once; the pieces are stored in the shared folder, in buckets by the
    part that made them, and stay there: what they need to know to find their place is
    sent to them.
    """
    pieces = write_bucketed(
        pieces_of(docs, tokenizer_path, text, keep, limit, end_id, with_ids),
        "part",
        shuffle_parts(docs),
    )
    # How many pieces of a length the parts before hold.
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    parts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    parts = store(parts.select("part", "length", "_n", before), "parts")
    histogram = np.zeros(limit + 1, np.int64)
    for length, n in parts.groupBy("length").agg(F.sum("_n")).collect():
        histogram[length] = n
    plan = make_plan(histogram)

    runs = np.array(sorted(plan.runs), np.int64).reshape(-1, 5)
    wide = 1 << 48
    table = pieces.sparkSession.sparkContext.broadcast(
        (runs[:, 0] * wide + runs[:, 1], runs[:, 1], runs[:, 3], runs[:, 4])
    )

    # One row a part, with its lengths and what is before them, goes to the pieces' buckets.
    lists = parts.groupBy("part").agg(
        F.collect_list(F.struct("length", "_before")).alias("_lists")
    )
    lists = lists.select(
        "part", F.col("_lists.length").alias("_lengths"), F.col("_lists._before").alias("_befores")
    )
    its_own = F.get("_befores", (F.array_position("_lengths", F.col("length")) - 1).cast("int"))
    ranked = pieces.join(lists.hint("shuffle_hash"), "part").withColumn(
        "place", F.col("place") + its_own
    )
    columns = [c for c in pieces.columns if c not in ("part", "place")]
    ranked = ranked.select(*[F.col(f"`{c}`") for c in columns], "place")
    schema = T.StructType(
        [*ranked.schema.fields[:-1], T.StructField("sequence_id", T.LongType()),
         T.StructField("offset", T.LongType())]
    )
    length_at = columns.index("length")

    def run(batches: Rows) -> Rows:
        keys, first, sequence, offset = table.value
        for batch in batches:
            lengths = batch.column(length_at).to_numpy(zero_copy_only=False)
            rank = batch.column(len(columns)).to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, lengths * wide + rank, "right") - 1
            placed = [pa.array(sequence[at] + rank - first[at]), pa.array(offset[at])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *placed], schema.names)

    return map_batches(ranked, run, schema)
