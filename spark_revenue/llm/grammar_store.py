"""Token ids on disk as Re-Pair grammars.

Documents are tokenised in ascending id order and written in blocks.  A block holds its ids as a sequence
of symbols and a list of rules: round by round the most frequent neighbouring pairs are replaced by new
symbols, each standing for its pair.  Pairs never reach across documents, and the block keeps where each
document's symbols start and how many ids each symbol expands to, so one document is decoded without
its neighbours.
"""

from __future__ import annotations

import re
import struct
import sys
import zlib
from collections.abc import Iterator
from pathlib import Path
from types import SimpleNamespace
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .shared import Scratch

END_ID = 2
# A block closes at this many ids, or after the document that passes it.
BLOCK_IDS = 1 << 21
PAIRS_PER_ROUND = 3072
LEAST_COUNT = 2
# With the tokenizer's 49,408 ids, symbols up to this stay within 16 bits.
MOST_SYMBOLS = 1 << 16
MAGIC = b"RPG1"
HEADER = "<4sBxxxIIQQI"
_TABLE_BITS = 18
_WORDS_KEPT = 400_000
_MARK = "<|endoftext|>"
# Letters of Latin-1, then ASCII marks; without the apostrophe and <, with which contractions and special tokens begin.
_SIMPLE = re.compile(r"([a-zß-öø-ÿÀ-ÖØ-Þ]+)([!-&(-/:;=-@\[-`{-~]*)")


class Grammar(NamedTuple):
    """``rules[k]`` is the pair behind symbol ``first + k``; ``lengths[k]`` is how many ids it expands to."""

    first: int
    rules: np.ndarray
    lengths: np.ndarray
    symbols: np.ndarray
    bounds: np.ndarray


def _joined(left: np.ndarray, right: np.ndarray, wide: bool) -> np.ndarray:
    """Neighbouring symbols as one number; 32 bits do where symbols have 16."""
    kind, shift = (np.uint64, 32) if wide else (np.uint32, 16)
    return (left.astype(kind) << kind(shift)) | right.astype(kind)


def frequent_pairs(keys: np.ndarray, most: int, least: int) -> np.ndarray:
    """The most frequent of the joined pairs, the most frequent first."""
    keys = np.sort(keys)
    if not len(keys) or most <= 0:
        return keys[:0]
    edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    counts, pairs = np.diff(edge), keys[edge[:-1]]
    often = np.flatnonzero(counts >= least)
    order = np.lexsort((pairs[often], -counts[often]))[:most]
    return pairs[often][order]


def _slots(keys: np.ndarray) -> np.ndarray:
    """Places of keys in the lookup table."""
    if keys.dtype == np.uint32:
        return (keys * np.uint32(0x9E3779B1)) >> np.uint32(32 - _TABLE_BITS)
    return (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _TABLE_BITS)


def compress(ids: np.ndarray, starts: np.ndarray, first: int) -> Grammar:
    """Re-Pair over the documents that begin at ``starts`` (the last entry is the end).

    Each round replaces the most frequent pairs at once, leftmost first where occurrences overlap.  It ends where
    no pair occurs twice, or no number is left for a symbol.
    """
    wide = first >= MOST_SYMBOLS or (len(ids) > 0 and int(ids.max()) >= first)
    first = max(first, int(ids.max()) + 1 if len(ids) else 0)
    most_rules = (1 << 31) - first if wide else MOST_SYMBOLS - first
    symbols, bounds = ids.astype(np.uint32), starts.astype(np.int64)
    left, right = np.zeros(0, np.int64), np.zeros(0, np.int64)
    while len(symbols) > 1:
        keys = _joined(symbols[:-1], symbols[1:], wide)
        cuts = bounds[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(symbols))] - 1
        inner = np.ones(len(keys), bool)
        inner[cuts] = False
        chosen = frequent_pairs(keys[inner], min(PAIRS_PER_ROUND, most_rules - len(left)), LEAST_COUNT)
        # Pairs that meet in a slot of the lookup table wait for the next round; the most frequent stays.
        _, keep = np.unique(_slots(chosen), return_index=True)
        chosen = chosen[np.sort(keep)]
        if not len(chosen):
            break
        number = np.zeros(1 << _TABLE_BITS, np.uint32)
        table = np.zeros(1 << _TABLE_BITS, keys.dtype)
        number[_slots(chosen)], table[_slots(chosen)] = np.arange(1, len(chosen) + 1), chosen
        place = _slots(keys)
        at = np.flatnonzero((table[place] == keys) & inner)
        at = at[number[place[at]] > 0]
        # Of a run of overlapping occurrences, every other one counts, from the left.
        run = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) > 1, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - run) % 2 == 0]
        symbols[at] = number[place[at]] + np.uint32(first + len(left) - 1)
        stays = np.ones(len(symbols), bool)
        stays[at + 1] = False
        bounds = bounds - np.searchsorted(at, bounds - 1)
        symbols = symbols[stays]
        bits = 32 if wide else 16
        left = np.concatenate([left, (chosen >> chosen.dtype.type(bits)).astype(np.int64)])
        right = np.concatenate([right, (chosen & chosen.dtype.type((1 << bits) - 1)).astype(np.int64)])
    lengths: list[int] = []
    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        lengths.append((1 if a < first else lengths[a - first]) + (1 if b < first else lengths[b - first]))
    return Grammar(first, np.stack([left, right], 1), np.array(lengths, np.int64), symbols, bounds)


def expand(grammar: Grammar, symbols: np.ndarray) -> np.ndarray:
    """The ids behind a stretch of symbols, by way of the ids behind each rule."""
    first = grammar.first
    flat: list[np.ndarray] = []
    for a, b in grammar.rules.tolist():
        flat.append(np.concatenate([flat[a - first] if a >= first else [a], flat[b - first] if b >= first else [b]]))
    table = np.concatenate([np.arange(first), *flat]).astype("<u4")
    lengths = np.concatenate([np.ones(first, np.int64), grammar.lengths])
    begins = np.cumsum(lengths) - lengths
    n = lengths[symbols]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return table[np.arange(total) + np.repeat(begins[symbols] - (ends - n), n)]


def document_ids(grammar: Grammar, number: int) -> np.ndarray:
    """Random access: the ids of one document of a block."""
    return expand(grammar, grammar.symbols[grammar.bounds[number] : grammar.bounds[number + 1]])


def to_bytes(g: Grammar) -> bytes:
    """A block's bytes: header, rules, expansion lengths, first symbol of each document, symbols."""
    top = max(g.first + len(g.rules), int(g.symbols.max()) + 1 if len(g.symbols) else 0)
    width = 2 if top <= 1 << 16 else 4
    body = [
        struct.pack(HEADER, MAGIC, width, g.first, len(g.rules), len(g.symbols), len(g.bounds), 0),
        g.rules.astype("<u4").tobytes(), g.lengths.astype("<u4").tobytes(), g.bounds.astype("<u8").tobytes(),
        g.symbols.astype(f"<u{width}").tobytes(),
    ]
    return b"".join(body)


def from_bytes(data: bytes) -> Grammar:
    magic, width, first, n_rules, n_symbols, n_bounds, _ = struct.unpack_from(HEADER, data)
    if magic != MAGIC:
        raise ValueError("not a grammar block")
    at = struct.calcsize(HEADER)
    parts = []
    for dtype, n in (("<u4", 2 * n_rules), ("<u4", n_rules), ("<u8", n_bounds), (f"<u{width}", n_symbols)):
        parts.append(np.frombuffer(data, dtype, n, at))
        at += parts[-1].nbytes
    return Grammar(first, parts[0].reshape(-1, 2).astype(np.int64), parts[1].astype(np.int64), parts[3].astype(np.int64), parts[2].astype(np.int64))


class WordEncoder:
    """Ids of whole texts from ids of their distinct words.

    The tokenizer never joins characters across white space, so a text's ids are those of its words in
    turn.  It lower-cases as well, so words are folded first, except where a special token may be meant.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_str(definition)
        self.size, self.mark = self.whole.get_vocab_size(), self.whole.token_to_id(_MARK)
        self.ends = np.zeros(self.size, bool)
        self.ends[[i for token, i in self.whole.get_vocab().items() if token.endswith("</w>")]] = True
        # Other tokenizers join words or tell cases apart; they get whole texts.
        probe = lambda t: self._encoded(self.whole, [t]).tolist()
        self.by_words = bool(self.ends.any()) and self.mark is not None and probe("Ab cd,\te") == probe("ab") + probe("cd") + probe(",") + probe("e")
        # For words that are folded already: without the normaliser, and parted at spaces only.
        self.plain = Tokenizer(self.whole.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self._clear()

    def _clear(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.ids, self.counts, self.fresh, self.seen = [], [], [], np.zeros(0, np.int32)

    def _forget(self) -> None:
        """Keep the words that occurred in several batches, at most half of what may be kept."""
        ids, counts = np.concatenate(self.ids), np.concatenate(self.counts)
        least = 2
        while (self.seen >= least).sum() > _WORDS_KEPT // 2:
            least *= 2
        keep = self.seen >= least
        self.known = self.known.filter(pa.array(keep))
        self.ids, self.counts = [ids[np.repeat(keep, counts)]], [counts[keep]]
        self.seen = np.ones(int(keep.sum()), np.int32)

    def _learn(self, words: list[str]) -> None:
        """Encode new words, many to a text.

        Letters, and marks after letters, are pieces of their own to the tokenizer, so each piece is encoded
        once, and the ids that end a piece part them.  Other words get a special token after each to tell them apart; one that may
        hold a special token itself is encoded alone.
        """
        simple, parts, marked, alone = [], [], [], []
        pieces: dict[str, int] = {}
        for w in words:
            if m := _SIMPLE.fullmatch(w):
                simple.append(w)
                parts.append((pieces.setdefault(m[1].lower(), len(pieces)), pieces.setdefault(m[2], len(pieces)) if m[2] else -1))
            else:
                (alone if "<|" in w else marked).append(w)
        listed = list(pieces)
        ids = self._encoded(self.plain, [" ".join(listed[i : i + 100]) for i in range(0, len(listed), 100)])
        ends = np.flatnonzero(self.ends[ids])
        if len(ends) != len(listed):
            raise ValueError("the tokenizer does not part letters from marks")
        flat = np.array(parts, np.int32).reshape(-1)
        lists, sizes = _lists(ids, np.diff(ends, prepend=-1)), np.append(np.diff(ends, prepend=-1), 0)
        self._add(simple, lists.take(pa.array(flat[flat >= 0])).values.to_numpy(), sizes[flat].reshape(-1, 2).sum(axis=1))
        ids = self._encoded(self.whole, ["".join([w + _MARK for w in marked[i : i + 100]]) for i in range(0, len(marked), 100)])
        self._add(marked, ids[ids != self.mark], np.diff(np.flatnonzero(ids == self.mark), prepend=-1) - 1)
        sizes = [len(e.ids) for e in self.whole.encode_batch(alone, add_special_tokens=False)]
        self._add(alone, self._encoded(self.whole, alone), np.array(sizes, np.int64))

    @staticmethod
    def _encoded(tokenizer, texts: list[str]) -> np.ndarray:
        found = [
            np.array(e.ids, np.int32) for i in range(0, len(texts), 50)
            for e in tokenizer.encode_batch_fast(texts[i : i + 50], add_special_tokens=False)
        ]
        return np.concatenate([np.zeros(0, np.int32), *found])

    def _add(self, words: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        if len(words) != len(counts):
            raise ValueError("the tokenizer joins pieces that white space or marks part")
        self.fresh += words
        self.counts.append(counts)
        self.ids.append(ids)

    def ids_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each has."""
        texts = texts.cast(pa.large_string()).fill_null("")
        if not self.by_words:
            found = [np.array(e.ids, np.int32) for e in self.whole.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            return np.concatenate([np.zeros(0, np.int32), *found]), np.array([len(x) for x in found], np.int64)
        split = pc.ascii_split_whitespace(texts)
        flat, lowered = split.flatten(), pc.ascii_lower(split.flatten())
        if pc.any(pc.match_substring(texts, "<|")).as_py():
            lowered = pc.if_else(pc.match_substring(flat, "<|"), flat, lowered)
        flat = lowered.dictionary_encode()
        words = flat.dictionary
        if len(self.known) and len(self.known) + len(words) > _WORDS_KEPT:
            self._forget()
        index = pc.index_in(words, value_set=self.known)
        new = words.filter(index.is_null())
        self._learn(new.to_pylist())
        learned, n = pa.array(self.fresh, pa.large_string()), len(self.known)
        self.known, self.fresh = pa.concat_arrays([self.known, learned]), []
        unknown = index.is_null().to_numpy(zero_copy_only=False)
        index = index.fill_null(0).to_numpy().astype(np.int32)
        index[unknown] = pc.index_in(new, value_set=learned).to_numpy() + n
        ids = np.concatenate([np.zeros(0, np.int32), *self.ids])
        counts = np.concatenate([np.zeros(0, np.int64), *self.counts])
        self.ids, self.counts = [ids], [counts]
        self.seen = np.concatenate([self.seen, np.zeros(len(counts) - len(self.seen), np.int32)])
        self.seen[index] += 1
        # The batch's own words first, so that the lookup for every word stays small.
        own = _lists(ids, counts).take(pa.array(index))
        # A stretch of words at a time keeps the offsets within 32 bits.
        found, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
        for i in range(0, len(flat), 1 << 24):
            lists = own.take(flat.indices.slice(i, 1 << 24))
            found.append(lists.values.to_numpy())
            sizes.append(np.diff(lists.offsets.to_numpy()))
        out = np.concatenate(found) if len(found) > 2 else found[-1]
        upto = np.zeros(len(flat) + 1, np.int64)
        np.cumsum(np.concatenate(sizes), out=upto[1:])
        offsets = split.offsets.to_numpy() - split.offsets[0].as_py() if len(split) else np.zeros(1, np.int64)
        return out, np.diff(upto[offsets])


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _encoder(definition: str) -> WordEncoder:
    """The encoder of this Python worker, which Spark keeps for later tasks, with the words it knows."""
    held = sys.modules.setdefault("_grammar_store_worker", SimpleNamespace(definition=None))
    if held.definition != definition:
        held.definition, held.encoder = definition, WordEncoder(definition)
    return held.encoder


def _with_ends(ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum(counts)
    return np.insert(ids, ends, END_ID), counts + 1


def _write(definition, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, block = _encoder(definition.value), TaskContext.get().partitionId(), 0
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        size = 0

        def close() -> pa.RecordBatch:
            nonlocal held, size, block
            counts = np.concatenate([c for _, _, c in held])
            grammar = compress(np.concatenate([x for _, x, _ in held]), np.concatenate([[0], np.cumsum(counts)]), encoder.size)
            names = pa.concat_arrays([d for d, _, _ in held])
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([shard]), pa.array([block]), pa.array([int(counts.sum())]),
                    pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names),
                    pa.array([to_bytes(grammar)], pa.binary()),
                ],
                ["shard", "block", "n_ids", "doc_ids", "payload"],
            )
            held, size, block = [], 0, block + 1
            return out

        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()
            row = 0
            while row < batch.num_rows:
                # About 4 MB of text at a time; one long text is taken whole.
                upto = row + max(1, int(np.searchsorted(np.cumsum(sizes[row:]), 1 << 22, "right")))
                part = batch.slice(row, upto - row)
                ids, counts = _with_ends(*encoder.ids_of(part.column("text")))
                held.append((part.column("doc_id"), ids, counts))
                size += len(ids)
                row = upto
                if size >= block_ids:
                    yield close()
        if held:
            yield close()
        # The worker waits for its next task; what Arrow has pooled meanwhile goes back.
        pa.default_memory_pool().release_unused()

    return run


def write_blocks(
    docs: DataFrame, path: str, tokenizer: str, *, text: str = "text", ident: str = "doc_id", block_ids: int = BLOCK_IDS,
) -> None:
    """Write the ids of all documents to ``path``, in ascending id order.

    ``tokenizer`` is the path of the tokenizer's file, read by the driver and sent to the tasks.  The table
    has a row for each block; shards are ranges of ids.  Null ids come first, and texts that share an id
    follow one another in the order of their hashes; a null text is one end id.
    """
    spark = docs.sparkSession
    definition = spark.sparkContext.broadcast(Path(tokenizer).read_text(encoding="utf-8"))
    rows = docs.select(F.col(ident).alias("doc_id"), F.col(text).cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    kind = dict(rows.dtypes)["doc_id"]
    schema = f"shard long, block long, n_ids long, doc_ids array<{kind}>, payload binary"
    dealt.mapInArrow(_write(definition, block_ids), schema).write.mode("overwrite").parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in range(batch.num_rows):
            grammar = from_bytes(batch.column("payload")[r].as_py())
            sizes = np.concatenate([np.ones(grammar.first, np.int64), grammar.lengths])[grammar.symbols]
            upto = np.concatenate([[0], np.cumsum(sizes)])[grammar.bounds]
            ids = expand(grammar, grammar.symbols).tobytes()
            view = memoryview(ids)
            crcs = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]
            names = batch.column("doc_ids")[r].values
            n = len(names)
            yield pa.RecordBatch.from_arrays(
                [
                    names, pa.array(np.full(n, batch.column("shard")[r].as_py())), pa.array(np.full(n, batch.column("block")[r].as_py())),
                    pa.array(upto[:-1]), pa.array(np.diff(upto)), pa.array(crcs, pa.int64()),
                ],
                ["doc_id", "shard", "block", "inside", "n_tokens", "ids_crc32"],
            )
    pa.default_memory_pool().release_unused()


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded from the blocks at ``path``."""
    blocks = spark.read.parquet(path)
    kind = dict(blocks.dtypes)["doc_ids"].removeprefix("array<").removesuffix(">")
    decoded = blocks.select("shard", "block", "doc_ids", "payload").mapInArrow(
        _read, f"doc_id {kind}, shard long, block long, inside long, n_tokens long, ids_crc32 long"
    )
    # One narrow row for each block of millions of ids.
    earlier = Window.orderBy("shard", "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("shard", "block", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("before"))
    joined = decoded.join(starts, ["shard", "block"])
    return joined.select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def tokenise(docs: DataFrame, tokenizer: str, *, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """Write the blocks to the shared folder and return what they hold.  An empty table has no blocks."""
    scratch = Scratch(docs.sparkSession)
    write_blocks(docs, scratch.path("blocks"), tokenizer, text=text, ident=ident)
    return read_documents(docs.sparkSession, scratch.path("blocks"))
