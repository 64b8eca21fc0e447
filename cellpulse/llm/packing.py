"""Best-fit packing of documents into token sequences, planned on the length histogram.

1. Every document is tokenised and closed with an end id. Documents longer than a sequence are
   cut into full pieces and a rest; nothing else is cut.
2. Only the histogram of piece lengths, at most one count per length up to the capacity,
   reaches the driver. Best-fit decreasing runs over counts: equal lengths go into equally
   filled sequences at once, so the plan's size follows the number of lengths, not of documents.
   A plan row says: pieces of this length with ranks from r to r + n - 1 take sequences s to
   s + n - 1 at this offset.
3. Each piece knows its rank within its length from its rank inside its own file part and the
   counts of that length in earlier parts, so no task sees all pieces of a frequent length.

Null text counts as empty: the document is one piece holding the end id alone. Repeated rows
are packed each on its own. An empty table gives an empty result. Special tokens' strings in a
text become their ids, as the tokenizer does by default.
"""

import bisect
import re
from array import array

from pyspark.sql import DataFrame, Window, functions as F

from cellpulse.llm.text import release
from cellpulse.session import materialise

SEQUENCE = 4096
END_ID = 1
CACHED_BYTES = 400_000_000  # bound of a worker's word cache
ENTRY_BYTES = 400          # of a stretch of text, its ids and the table's entry
LONGEST_CACHED = 64        # characters; longer stretches are encoded each time
_GATHERED = 500_000        # stretches whose ids are put in order at a time
# Letters that stay single letters in any normal form and case, then ASCII marks up to the end.
_PLAIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017e\u0400-\u045f]+)"
                    r"([!-/:-@\[-`{-~]*)")
_PIECES = ("doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, "
           "part int, local bigint")


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes.

    The tokenizer never joins characters across a space or line feed, so each stretch between
    them is encoded once and kept while there is room. It lower-cases by itself; doing that for
    A-Z first lets more stretches agree, except in texts that may hold special tokens.

    Marks after a word's last letter are always tokens of their own, so new stretches share the
    ids of words and marks. New words are encoded many at a time, parted by spaces, where the
    model closes each word with a token of its own kind.
    """

    def __init__(self, path: str, cached_bytes: int = None):
        import numpy as np
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.room = CACHED_BYTES if cached_bytes is None else cached_bytes
        self.known = {}
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(1 + max(vocabulary.values(), default=0), bool)
        if suffix:
            self.closes[[n for t, n in vocabulary.items() if t.endswith(suffix)]] = True

    def encode(self, texts) -> list:
        """The ids of each text of a list or Arrow array."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        if not len(texts):
            return []
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()),
                             "")
        lower = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        parted = pc.split_pattern(pc.replace_substring(lower, "\n", " "), " ")
        coded = parted.flatten().dictionary_encode()
        ids = self._of_stretches(coded.dictionary.to_pylist())
        size = np.fromiter(map(len, ids), "int64", len(ids)) // 4
        pool = np.frombuffer(b"".join(ids), "<u4")
        first = np.cumsum(size) - size
        at = coded.indices.to_numpy()
        ends = np.cumsum(pc.list_value_length(parted).to_numpy(), dtype="int64")
        del lower, parted, coded
        out, begin = [], 0
        while len(out) < len(ends):
            # The stretches of some texts: where their ids begin in the pool, where they go.
            upto = max(int(np.searchsorted(ends, begin + _GATHERED, "right")), len(out) + 1)
            some = at[begin:ends[upto - 1]]
            n = size[some]
            to = np.concatenate([[0], np.cumsum(n)])
            raw = pool[np.arange(to[-1]) + np.repeat(first[some] - to[:-1], n)].tobytes()
            cuts = (to[np.concatenate([[begin], ends[len(out):upto]]) - begin] * 4).tolist()
            out += [raw[a:b] for a, b in zip(cuts, cuts[1:])]
            begin = int(ends[upto - 1])
        return out

    def _of_stretches(self, stretches: list) -> list:
        out = list(map(self.known.get, stretches))
        new = [n for n, ids in enumerate(out) if ids is None]
        found = self._encode([stretches[n] for n in new])
        for n in new:
            out[n] = found[stretches[n]]
        if self.room > 0:
            kept = {w: i for w, i in found.items() if len(w) <= LONGEST_CACHED}
            self.known.update(kept)
            self.room -= ENTRY_BYTES * len(kept)
        return out

    def _encode(self, new: list) -> dict:
        """The ids of new stretches, and of the words and marks in them that are new too."""
        known, found, marked, words, others = self.known, {}, [], {}, {}
        for stretch in new:
            plain = _PLAIN.fullmatch(stretch)
            if plain is None:
                others[stretch] = None
                continue
            word, marks = plain.groups()
            if word not in known:
                words[word] = None
            if marks:
                marked.append((stretch, word, marks))
                if marks not in known:
                    others[marks] = None
        words, others = list(words), list(others)
        for at in range(0, len(words), 20_000):
            some = words[at:at + 20_000]
            found.update(zip(some, self._words(some)))
        for at in range(0, len(others), 20_000):
            some = others[at:at + 20_000]
            found.update(zip(some, self._each(some)))
        for stretch, word, marks in marked:
            found[stretch] = ((found[word] if word in found else known[word])
                              + (found[marks] if marks in found else known[marks]))
        return found

    def _each(self, stretches: list) -> list:
        return [array("I", ids.ids).tobytes() for ids in self.tokenizer.encode_batch_fast(
            stretches, add_special_tokens=False)]

    def _words(self, words: list) -> list:
        """The ids of words of letters, encoded side by side."""
        import numpy as np
        groups = [words[at:at + 200] for at in range(0, len(words), 200)]
        out = []
        for group, ids in zip(groups, self.tokenizer.encode_batch_fast(
                [" ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(ids.ids, "<u4")
            ends = (4 * (np.flatnonzero(self.closes[ids]) + 1)).tolist()
            if len(ends) != len(group):
                out += self._each(group)  # a model that does not close words
                continue
            raw = ids.tobytes()
            out += [raw[a:b] for a, b in zip([0, *ends], ends)]
        return out


_ENCODERS = {}


def encoder_of(path: str, cached_bytes: int = None) -> WordEncoder:
    """The worker's encoder, kept from task to task; the last one only."""
    if (path, cached_bytes) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path, cached_bytes] = WordEncoder(path, cached_bytes)
    return _ENCODERS[path, cached_bytes]


def _small_groups(texts, limit: int = 1 << 22):
    """Slices of an Arrow array of texts, each closed by the row that brings it to the limit."""
    import numpy as np
    import pyarrow.compute as pc
    held = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), dtype="int64")
    at = before = 0
    while at < len(texts):
        end = min(int(np.searchsorted(held, before + limit)) + 1, len(texts))
        yield texts.slice(at, end - at)
        at, before = end, int(held[end - 1])


def pieces(docs: DataFrame, tokenizer: str, capacity: int = SEQUENCE, end_id: int = END_ID,
           key: str = "doc_id", text: str = "text", cached_bytes: int = None) -> DataFrame:
    """One row per piece, stored once: ``part`` names the writing task, ``local`` the rank of
    the piece among those of equal length in that part."""
    slim = docs.select(F.col(f"`{key}`").alias("doc_id"),
                       F.col(f"`{text}`").cast("string").alias("text"))
    kind = dict(slim.dtypes)["doc_id"]
    closing = int(end_id).to_bytes(4, "little")

    def run(batches):
        import os
        import zlib

        import pyarrow as pa
        from pyspark import TaskContext
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = encoder_of(tokenizer, cached_bytes)
        part = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        step = capacity * 4
        for batch in batches:
            row = 0
            for texts in _small_groups(batch.column(1)):
                out = {n: [] for n in ("row", "piece", "start", "length", "crc", "local")}
                for ids in encoder.encode(texts):
                    ids += closing
                    for number, at in enumerate(range(0, len(ids), step)):
                        some = ids[at:at + step]
                        size = len(some) // 4
                        out["row"].append(row)
                        out["piece"].append(number)
                        out["start"].append(at // 4)
                        out["length"].append(size)
                        out["crc"].append(zlib.crc32(some))
                        out["local"].append(seen[size])
                        seen[size] += 1
                    row += 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(out["row"], pa.int64())),
                     pa.array(out["piece"], pa.int32()), pa.array(out["start"], pa.int64()),
                     pa.array(out["length"], pa.int64()), pa.array(out["crc"], pa.int64()),
                     pa.array([part] * len(out["row"]), pa.int32()),
                     pa.array(out["local"], pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "local"])
        release()
    return materialise(slim.mapInArrow(run, _PIECES.format(kind=kind)), "pieces")


def plan_counts(counts: dict, capacity: int = SEQUENCE) -> list:
    """Best-fit decreasing over a length histogram.

    Returns rows (length, first rank, pieces, first sequence, offset). Open sequences are kept
    as ranges of equal fill, by room left; the fullest that still has room is taken first.
    """
    plan, rooms, open_at, sequences = [], [], {}, 0

    def put(room, first, n):
        if room:
            if room not in open_at:
                bisect.insort(rooms, room)
            open_at.setdefault(room, []).append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = open_at[room].pop()
                if not open_at[room]:
                    del open_at[room], rooms[at]
                used = min(n, left)
                if n > used:
                    put(room, first + used, n - used)
            else:
                # No open sequence has room: open as many as these pieces fill side by side.
                room, first = capacity, sequences
                used = -(-left // (capacity // length))
                sequences += used
            plan.append((length, rank, used, first, capacity - room))
            rank, left = rank + used, left - used
            put(room - length, first, used)
    return plan


def place(found: DataFrame, capacity: int = SEQUENCE) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces."""
    spark = found.sparkSession
    per_part = found.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    per_part = materialise(per_part, "lengths")
    histogram = {r["length"]: r["n"] for r in
                 per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.sparkContext.broadcast(_columns(plan_counts(histogram, capacity)))
    earlier = (Window.partitionBy("length").orderBy("part")
               .rowsBetween(Window.unboundedPreceding, -1))
    before = per_part.select("length", "part",
                             F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    ranked = found.join(before, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("earlier") + F.col("local")).alias("rank"))
    kind = dict(found.dtypes)["doc_id"]

    def run(batches):
        import numpy as np
        import pyarrow as pa
        key, first_rank, first_sequence, offset = plan.value
        for batch in batches:
            length = batch.column(3).to_numpy()
            rank = batch.column(5).to_numpy()
            row = np.searchsorted(key, (length << 44) + rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(first_sequence[row] + rank - first_rank[row]),
                 pa.array(offset[row])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id",
                       "offset"])
    return ranked.mapInArrow(
        run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, "
             "sequence_id bigint, offset bigint")


def _columns(plan: list) -> tuple:
    import numpy as np
    rows = np.array(sorted(plan), "int64").reshape(-1, 5)
    return (rows[:, 0] << 44) + rows[:, 1], rows[:, 1], rows[:, 3], rows[:, 4]


def pack(docs: DataFrame, tokenizer: str = None, capacity: int = SEQUENCE, end_id: int = END_ID,
         key: str = "doc_id", text: str = "text", cached_bytes: int = None) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    ``cached_bytes`` bounds the encoded words that a worker keeps.
    """
    return place(pieces(docs, tokenizer or default_tokenizer(), capacity, end_id, key, text,
                        cached_bytes), capacity)
