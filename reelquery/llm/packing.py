"""Operator 9: packing token sequences by shortest-pack-first over the length histogram.

1. One Arrow pass tokenises whole texts and cuts each document every ``max_len`` ids. Only the pieces'
   lengths and checksums leave the pass; they are written to the shared folder. Each distinct word is
   tokenised once while a worker keeps it, since the tokenizer never looks across white space.
2. The histogram has at most ``max_len`` bars, however many documents there are. On it the driver places
   lengths longest first, always into the packs with most room, keeping only patterns and their counts.
3. Each piece gets its rank among pieces of its length (ranks are counted in blocks of about ``BLOCK_ROWS`` and the
   blocks' sizes summed, so a hot length isn't one task) and the rank leads to its pattern, pack and offset.

Null and empty texts are one piece of the end id. Rows count one by one, also when ids repeat; null ids stay
null. Very long texts are cut into as many pieces as they need; pieces of equal length are alike to the packing. An
empty table gives no pieces. Other columns are not read. A sequence whose length is a power of two
needs no padding and keeps its length; all others are padded to max_len (padded_length).
"""

from __future__ import annotations

import re
import uuid
import zlib
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ENTRY_BYTES, MEMO_BYTES, Scratch, kept, quoted, sliced

#: A block of equal lengths holds about so many pieces, whose order is one task's work.
MAX_LEN, END_ID, BLOCK_ROWS = 4096, 2, 1_000_000
#: What a worker's known words hold, and what it tokenises at once; arrays of its ids take some 15 times that.
WORDS_BYTES, TEXT_ROWS, TEXT_BYTES = MEMO_BYTES // 2, 500, 2 << 20
#: Bound of the slot table that is sent to executors: 4 numbers a row.
MOST_SLOTS = 2_000_000
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PIECE_COLUMNS = [x.split()[0] for x in PIECE.split(", ")]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def ends_in_letter(w: bytes) -> bool:
    """Whether a lower-case letter of two bytes that normalising keeps (Latin, to U+023F) stands before the last byte."""
    return len(w) > 2 and w[-2] >= 128 and 0xC3 <= w[-3] <= 0xC8 and (c := w[-3:-1].decode()).isalpha() and c.islower()


#: Words of letters that normalising keeps (a-z, U+00DF to U+00FF but for the division sign) and marks after them; or any other word.
LETTERS = rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+"
MARKS = rb"[!-&(-/:-@\[-`{-~]+"
SIMPLE = re.compile(rb"^(?:(" + LETTERS + rb")(" + MARKS + rb")?|(.+))$", re.MULTILINE)
#: How byte-level vocabularies write bytes: printable ones as they are, the others from U+0100 on.
SHOWN = {b for part in ((33, 127), (161, 173), (174, 256)) for b in range(*part)}
BYTE_CHARS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in SHOWN)}


def byte_level(word: bytes) -> str:
    return word.decode() if word.isascii() else word.decode("latin-1").translate(BYTE_CHARS)


class WordIds:
    """Packed ids of words (ASCII white space apart), each tokenised once while it is kept.

    The tokenizer never looks across white space. Where its first steps are seen to leave words of plain letters whole and to part
    ASCII marks from them, such words go straight to its model. Other letters-only words are tokenised many at a time, as each ends
    with a token that ends a word; where the numbers don't agree, and for the rest, one by one. Of a word
    with one punctuation mark after a letter, both parts are looked up. At so many bytes, only words that were met again stay.
    """

    def __init__(self, path: str, most: int = WORDS_BYTES):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.ends = np.zeros(self.tok.get_vocab_size() + 1, bool)
        self.packed = [k.to_bytes(4, "little") for k in range(len(self.ends))]
        for token, k in self.tok.get_vocab().items():
            self.ends[k] = token.endswith("</w>")
        self.known: dict[bytes, bytes] = {}
        self.again: set[bytes] = set()
        self.most, self.held = most, 0
        self.simple = self._keeps_letters()

    def _keeps_letters(self) -> bool:
        """Whether normalising and splitting do to SIMPLE words what straight() takes for granted."""
        if self.tok.normalizer is None or self.tok.pre_tokenizer is None:
            return False
        letters = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
        marks = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
        cases = [(letters, marks), (letters[::-1], marks[::-1])] + [(a, b) for a in letters for b in marks]
        parts = [[p for p, _ in self.tok.pre_tokenizer.pre_tokenize_str(self.tok.normalizer.normalize_str(a + b))] for a, b in cases]
        return all(p == [byte_level(a.encode()), b] for (a, b), p in zip(cases, parts, strict=True))

    def straight(self, part: bytes) -> bytes:
        """Ids of plain letters or of marks by the model alone."""
        return b"".join([self.packed[t.id] for t in self.model.tokenize(byte_level(part))])

    def learn(self, words: set[bytes]) -> None:
        known = self.known
        if self.held > self.most:
            self.known = known = {w: known[w] for w in self.again if w in known}
            self.held = sum(map(self._size, known.items()))
            if self.held > self.most // 2:
                self.known = known = {}
                self.held = 0
            self.again = set()
        new = words.difference(known)
        n = len(known)
        self.again.update(words.difference(new))
        if self.simple:
            new = self._learn_simple(new)
        self._learn_rest(new)
        added = len(known) - n
        self.held += added * (ENTRY_BYTES + 66) + sum(map(len, islice(reversed(known), added))) + sum(map(len, islice(reversed(known.values()), added)))

    def _learn_simple(self, new: set[bytes]) -> set[bytes]:
        known, straight, rest = self.known, self.straight, set()
        for letters, marks, other in SIMPLE.findall(b"\n".join(new)):
            if other:
                rest.add(other)
                continue
            ids = known.get(letters)
            if ids is None:
                ids = known[letters] = straight(letters)
            if marks:
                after = known.get(marks)
                if after is None:
                    after = known[marks] = straight(marks)
                known[letters + marks] = ids + after
        return rest

    def _learn_rest(self, new: set[bytes]) -> None:
        known = self.known
        marked = [w for w in new if w[-1] in b",.;:!?" and len(w) > 1 and (97 <= w[-2] <= 122 or ends_in_letter(w))]
        new.difference_update(marked)
        new.update({x for w in marked for x in (w[:-1], w[-1:])}.difference(known))
        plain, other = [], []
        for w in new:
            (plain if w.isalpha() or w.decode().isalpha() else other).append(w)
        for k in range(0, len(plain), 200):
            part = plain[k : k + 200]
            ids = np.array(self.tok.encode(b" ".join(part).decode(), add_special_tokens=False).ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(part):
                other += part
                continue
            packed, start = ids.tobytes(), 0
            for w, stop in zip(part, (4 * cuts).tolist(), strict=True):
                known[w] = packed[start:stop]
                start = stop
        for k in range(0, len(other), 10_000):
            part = other[k : k + 10_000]
            for w, e in zip(part, self.tok.encode_batch_fast([w.decode() for w in part], add_special_tokens=False), strict=True):
                known[w] = np.array(e.ids, "<u4").tobytes()
        for w in marked:
            known[w] = known[w[:-1]] + known[w[-1:]]

    @staticmethod
    def _size(entry: tuple[bytes, bytes]) -> int:
        return ENTRY_BYTES + 66 + len(entry[0]) + len(entry[1])


def as_bytes(words: pa.Array) -> list[bytes]:
    """Words without line breaks as Python bytes, by one join and one split."""
    return pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), "\n")[0].as_py().encode().split(b"\n") if len(words) else []


def piece_maker(path: str, max_len: int, end_id: int):
    """Makes the function from a batch of texts to their pieces. Texts are split and told apart by Arrow, so Python sees each word once a batch."""

    def make():
        words_ids = WordIds(path)
        end = np.array([end_id], "<u4").tobytes()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            text = pc.fill_null(batch.column("text"), "")
            text = pc.if_else(pc.match_substring(text, "<|"), text, pc.ascii_lower(text))
            split = pc.ascii_split_whitespace(text)  # with an empty word before blanks at the start and after those at the end
            coded = split.flatten().dictionary_encode()
            words = as_bytes(coded.dictionary)
            words_ids.learn({w for w in words if w})
            packed = [words_ids.known[w] if w else b"" for w in words]
            sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
            firsts = np.cumsum(sizes) - sizes
            word = coded.indices.to_numpy(zero_copy_only=False)
            n = sizes[word]
            stops = np.concatenate([[0], np.cumsum(n)])
            at = np.repeat(firsts[word] - stops[:-1], n)
            at += np.arange(len(at))
            ids = np.frombuffer(b"".join(packed), "<u4")[at]
            bounds = stops[split.offsets.to_numpy()].tolist()
            row, rest = [], ([], [], [], [])
            for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                raw, tokens = ids[a:b].tobytes() + end, b - a + 1
                for start in range(0, tokens, max_len):
                    piece = raw[start * 4 : (start + max_len) * 4]
                    row.append(k)
                    for kept_values, value in zip(rest, (start, len(piece) // 4, zlib.crc32(piece), tokens), strict=True):
                        kept_values.append(value)
            doc_id = batch.column("doc_id").take(pa.array(row, pa.int64()))
            return pa.RecordBatch.from_arrays([doc_id, *(pa.array(v, pa.int64()) for v in rest)], PIECE_COLUMNS)

        return work

    return make


def tokenized(docs: DataFrame, path: str, max_len: int, end_id: int) -> DataFrame:
    """The pieces of docs (doc_id, text); what a worker knows of words stays with it between its tasks."""
    make, key = piece_maker(path, max_len, end_id), uuid.uuid4().hex

    def run(batches):
        work = kept(key, make)
        for batch in sliced(batches, TEXT_ROWS, TEXT_BYTES):
            yield work(batch)

    return docs.select("doc_id", "text").mapInArrow(run, PIECE)


def shortest_pack_first(histogram: dict[int, int], max_len: int) -> tuple[np.ndarray, int]:
    """Slots as rows (length, first rank, first sequence, offset), sorted; and the number of sequences.

    Piece number r of its length lies in the slot with the largest first rank <= r, in sequence
    first sequence + r - first rank.
    """
    room: dict[int, list] = {}  # room left -> [(packs, chain)]; a chain is (length, offset, chain before) or None
    full = []
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            most = max(room, default=0)  # the shortest packs
            if most >= length:
                packs, chain = room[most].pop()
                take = min(packs, left)
                if packs > take:
                    room[most].append((packs - take, chain))
                if not room[most]:
                    del room[most]
            else:
                most, take, chain = max_len, left, None
            new = (take, (length, max_len - most, chain))
            if most > length:
                room.setdefault(most - length, []).append(new)
            else:
                full.append(new)
            left -= take
    slots, rank, sequence = [], dict.fromkeys(histogram, 0), 0
    for packs, chain in full + [p for k in sorted(room) for p in room[k]]:
        while chain:
            length, offset, chain = chain
            slots.append((length, rank[length], sequence, offset))
            rank[length] += packs
        sequence += packs
    return np.array(sorted(slots), dtype=np.int64).reshape(-1, 4), sequence


def pack_pieces(pieces: DataFrame, max_len: int = MAX_LEN, block_rows: int = BLOCK_ROWS, most_slots: int = MOST_SLOTS) -> DataFrame:
    """pieces as stored in the shared folder; adds sequence_id, offset and padded_length."""
    spark = pieces.sparkSession
    histogram = dict(map(tuple, pieces.groupBy("length").count().collect()))  # max_len rows at most
    slots, _ = shortest_pack_first(histogram, max_len)
    if len(slots) > most_slots:
        raise ValueError(f"{len(slots)} slots; raise most_slots if executors have the memory")
    used = dict.fromkeys(slots[:, 2].tolist(), 0)
    ends = np.zeros(0)
    if len(slots):
        for length, _, sequence, _ in slots.tolist():
            used[sequence] += length
        ends = np.array([used[s] for s in slots[:, 2].tolist()])
    sent = spark.sparkContext.broadcast((slots, ends))
    blocks = pa.table({"length": pa.array(histogram.keys(), pa.int64()), "_blocks": pa.array((-(-n // block_rows) for n in histogram.values()), pa.int64())})
    many = F.broadcast(spark.createDataFrame(blocks))  # max_len rows at most; from Arrow, as a list would start Python workers of its own
    # blocks by the place of a row in its file, so that equal rows don't share one
    at = F.xxhash64(F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1), "_metadata.row_index")
    p = pieces.select("*", at.alias("_at")).join(many, "length").withColumn("_b", F.pmod("_at", "_blocks"))
    p = p.withColumn("_r", F.row_number().over(Window.partitionBy("length", "_b").orderBy("doc_id", "start", "ids_crc32", "_at")) - 1)
    sizes = p.groupBy("length", "_b").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("length").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # a row a block
    ranked = p.join(sizes.select("length", "_b", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")), ["length", "_b"])
    ranked = ranked.select(*PIECE_COLUMNS, (F.col("_before") + F.col("_r")).alias("_rank"))
    schema = f"{PIECE}, sequence_id long, offset long, padded_length long"

    def place(batches):
        slots, ends = sent.value
        keys = slots[:, 0] * 2**40 + slots[:, 1]
        for b in batches:
            length, rank = (b.column(k).to_numpy(zero_copy_only=False) for k in ("length", "_rank"))
            at = np.searchsorted(keys, length * 2**40 + rank, "right") - 1
            total = ends[at].astype(np.int64)
            padded = np.where(total & (total - 1) == 0, total, max_len)
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in PIECE_COLUMNS), pa.array(slots[at, 2] + rank - slots[at, 1]), pa.array(slots[at, 3]), pa.array(padded)], [*PIECE_COLUMNS, "sequence_id", "offset", "padded_length"])

    return ranked.mapInArrow(place, schema)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, max_len: int = MAX_LEN, end_id: int = END_ID) -> DataFrame:
    """One row a piece: where it comes from and where it lies."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    d = docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).alias("text"))
    pieces = scratch.write(tokenized(d, tokenizer or default_tokenizer(), max_len, end_id), "pieces")
    return pack_pieces(pieces, max_len)
