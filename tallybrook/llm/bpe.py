"""Byte-level BPE.

Words are counted over all documents; those that are frequent are encoded by Spark's higher-order
functions, a fold of ranked merges with a literal rank map. There bytes are written as two hexadecimal
digits, so pieces are strings and joining pieces joins bytes. The resulting dictionary, of bounded
size, goes to all tasks; a task merges the rare words itself, by the same ranks.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import byte_batches, stage

#: Buckets of the literal rank map: an entry is found by its checksum, then among a few.
RANK_BUCKETS = 1 << 16
#: Most frequent words whose tokens are worked out once and sent to all tasks, and their longest length.
DICTIONARY_WORDS = 1 << 17
DICTIONARY_BYTES = 64
#: Longest words whose pairs are all looked through for the next merge.
SHORT_BYTES = 32
#: Rare words that a task remembers.
REMEMBERED_WORDS = 1 << 18
#: Above every rank: no piece.
NO_RANK = (1 << 31) - 1
# Characters that are white space to the tokenizer's pattern.
WHITE_SPACE = r"\t-\r \x85\xa0  -     　"


def read_ranks(path: str) -> dict[bytes, int]:
    """Pieces and ranks of a rank file: base 64 piece and decimal rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in lines if line.strip())}


def spelled_out(pattern: str) -> str:
    """The pattern with white space spelled out: the engines differ in what is white space."""
    return pattern.replace(r"[^\s", f"[^{WHITE_SPACE}").replace(r"\s", f"[{WHITE_SPACE}]").replace(r"\S", f"[^{WHITE_SPACE}]")


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.transform(F.array(value), lambda x: use(x))[0]


def _rank_literal(ranks: dict[bytes, int]) -> Column:
    buckets: list[dict[str, int]] = [{} for _ in range(RANK_BUCKETS)]
    for piece, rank in ranks.items():
        key = piece.hex().upper()
        buckets[zlib.crc32(key.encode()) % RANK_BUCKETS][key] = rank
    return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,int>>")


def _piece_literal(ranks: dict[bytes, int]) -> Column:
    pieces = [""] * (max(ranks.values(), default=-1) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece.hex().upper()
    return F.from_json(F.lit(json.dumps(pieces)), "array<string>")


def _found(maps: Column, key: Column, buckets: int) -> Column:
    place = F.pmod(F.crc32(key.cast("binary")), F.lit(buckets)).cast("int")
    return F.try_element_at(maps[place], key)


def _rank(maps: Column, piece: Column) -> Column:
    return F.coalesce(_found(maps, piece, RANK_BUCKETS), F.lit(NO_RANK))


def _merge_once(maps: Column, state: Column) -> Column:
    """Join the first pair of least rank; the pairs beside it get new ranks, all others stay."""
    pieces, ranks = state["pieces"], state["ranks"]

    def joined(p: Column) -> Column:
        def with_piece(piece: Column) -> Column:
            left = F.when(p > 1, F.array(_rank(maps, F.concat(pieces[p - 2], piece)))).otherwise(F.array().cast("array<int>"))
            right = F.when(p < F.size(ranks), F.array(_rank(maps, F.concat(piece, pieces[p + 1])))).otherwise(
                F.array().cast("array<int>")
            )
            return F.struct(
                F.concat(F.slice(pieces, F.lit(1), p - 1), F.array(piece), F.slice(pieces, p + 2, F.size(pieces))).alias("pieces"),
                F.concat(F.slice(ranks, F.lit(1), F.greatest(p - 2, F.lit(0))), left, right, F.slice(ranks, p + 2, F.size(ranks))).alias("ranks"),
            )

        return _let(F.concat(pieces[p - 1], pieces[p]), with_piece)

    def merged(least: Column) -> Column:
        return F.when(least == NO_RANK, state).otherwise(_let(F.array_position(ranks, least).cast("int"), joined))

    return _let(F.coalesce(F.array_min(ranks), F.lit(NO_RANK)), merged)


def encode_word(maps: Column, word: Column) -> Column:
    """The token ids of one word, joined by spaces: the whole word if it is a piece, else a fold of
    merges over its bytes."""

    def fold(bytes_: Column) -> Column:
        size = F.size(bytes_)
        pairs = F.when(size > 1, F.transform(
            F.sequence(F.lit(0), size - 2), lambda i: _rank(maps, F.concat(bytes_[i], bytes_[i + 1]))
        )).otherwise(F.array().cast("array<int>"))
        start = F.struct(bytes_.alias("pieces"), pairs.alias("ranks"))
        end = F.aggregate(F.sequence(F.lit(1), size), start, lambda state, _: _merge_once(maps, state))["pieces"]
        return F.array_join(F.transform(end, lambda piece: _rank(maps, piece).cast("string")), " ")

    def tokens(digits: Column) -> Column:
        bytes_ = F.transform(
            F.sequence(F.lit(0), (F.length(digits) / 2).cast("int") - 1), lambda i: F.substr(digits, i * 2 + 1, F.lit(2))
        )
        return F.coalesce(_found(maps, digits, RANK_BUCKETS).cast("string"), _let(bytes_, fold))

    return _let(F.hex(F.encode(word, "UTF-8")), tokens)


def words_of(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(spelled_out(pattern)), F.lit(0))


def word_dictionary(documents: DataFrame, ranks: dict[bytes, int], pattern: str) -> dict[str, tuple[int, ...]]:
    """The ids of the frequent words, counted over all documents.

    The counts of counts say from which count on at most ``DICTIONARY_WORDS`` words are frequent.
    """
    words = documents.select(F.explode(words_of(F.col("text"), pattern)).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    words = stage(words.where(F.octet_length("word") <= DICTIONARY_BYTES), "words", "zstd")
    from_count, total = 1, 0
    for row in words.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n")).toLocalIterator():
        total += row["words"]
        if total > DICTIONARY_WORDS:
            from_count = row["n"] + 1
            break
    frequent = words.where(F.col("n") >= from_count).select(
        "word", _let(_rank_literal(ranks), lambda maps: encode_word(maps, F.col("word"))).alias("ids")
    )
    return {row["word"]: tuple(map(int, row["ids"].split(" "))) for row in stage(frequent, "frequent-words").toLocalIterator()}


def merge(word: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """The ids of one word: whole, if it is a piece, else by merges of least rank, the first of equals."""
    if word in ranks:
        return (ranks[word],)
    return _merge_long(word, ranks) if len(word) > SHORT_BYTES else _merge_short(word, ranks)


def _merge_short(word: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Looks through all pairs for the next merge: quick for few bytes."""
    pieces = [word[i : i + 1] for i in range(len(word))]
    found = ranks.get
    pairs = [found(a + b, NO_RANK) for a, b in zip(pieces, pieces[1:])]
    while pairs:
        least = min(pairs)
        if least == NO_RANK:
            break
        i = pairs.index(least)
        pieces[i : i + 2] = [pieces[i] + pieces[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = found(pieces[i - 1] + pieces[i], NO_RANK)
        if i < len(pairs):
            pairs[i] = found(pieces[i] + pieces[i + 1], NO_RANK)
    return tuple([ranks[p] for p in pieces])


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Keeps the pairs in a heap: time follows the bytes and their logarithm."""
    n = len(word)
    after, before, gone = list(range(1, n + 1)), list(range(-1, n - 1)), bytearray(n)
    heap = [(ranks[word[i : i + 2]], i, i + 2) for i in range(n - 1) if word[i : i + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        j = after[i]
        if gone[i] or j >= n or after[j] != end:
            continue  # one of the two was merged meanwhile
        after[i], gone[j] = end, 1
        if end < n:
            before[end] = i
            if (rank := ranks.get(word[i : after[end]])) is not None:
                heapq.heappush(heap, (rank, i, after[end]))
        if (p := before[i]) >= 0 and (rank := ranks.get(word[p:end])) is not None:
            heapq.heappush(heap, (rank, p, end))
    return tuple(ranks[word[i : after[i]]] for i in range(n) if not gone[i])


class Encoder:
    """Text to ids in a task: words in the dictionary, then words met before, then a merge.

    ``made`` turns a word's ids into what is wanted of it, once for each word that is remembered. That
    is bounded: the dictionary and ``REMEMBERED_WORDS`` besides.
    """

    def __init__(self, dictionary: dict[str, tuple[int, ...]], ranks: dict[bytes, int], pattern: str, made=lambda ids: ids):
        self.dictionary = {word: made(ids) for word, ids in dictionary.items()}
        self.ranks, self.made, self.met = ranks, made, {}
        self.words = regex.compile(spelled_out(pattern)).findall

    def of_words(self, text: str) -> list:
        """What was made of every word of a text, in order."""
        words = self.words(text)
        found = list(map(self.dictionary.get, words))
        if None in found:
            for i, made in enumerate(found):
                if made is None:
                    found[i] = self._merged(words[i])
        return found

    def ids(self, text: str) -> list[int]:
        return list(itertools.chain.from_iterable(self.of_words(text)))

    def _merged(self, word: str):
        made = self.met.get(word)
        if made is None:
            made = self.made(merge(word.encode(), self.ranks))
            if len(word) <= DICTIONARY_BYTES:
                if len(self.met) >= REMEMBERED_WORDS:
                    self.met.clear()
                self.met[word] = made
        return made


def _encoder(documents: DataFrame, rank_path: str, pattern: str):
    """A broadcast of bounded size: the dictionary, the ranks and the pattern."""
    ranks = read_ranks(rank_path)
    return documents.sparkSession.sparkContext.broadcast((word_dictionary(documents, ranks, pattern), ranks, pattern))


def encode_documents(documents: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) of every document; a null text is an empty one and has no ids."""
    parts = _encoder(documents, rank_path, pattern)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*parts.value)
        for batch in byte_batches(batches, "text"):
            ids = [encoder.ids(text.as_py() or "") for text in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, "doc_id long, ids array<int>")


def decode_ids(ids: Column, rank_path: str) -> Column:
    """The bytes of an array of ids: their pieces one after the other."""

    def decoded(pieces: Column) -> Column:
        return F.unhex(F.array_join(F.transform(ids, lambda i: pieces[i]), ""))

    return _let(_piece_literal(read_ranks(rank_path)), decoded)


def token_digests(documents: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document.

    The ids become digests where they are made, so they need not move. Of every word that a task
    remembers it keeps the number of ids, the ids in decimal, and the bytes that they decode to: the
    ids' pieces, joined. A text's are those of its words, one after the other.
    """
    parts = _encoder(documents, rank_path, pattern)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary, ranks, pattern_ = parts.value
        pieces = {rank: piece for piece, rank in ranks.items()}
        decimal = {rank: str(rank) for rank in pieces}

        def made(ids: tuple[int, ...]) -> tuple[int, str, bytes]:
            return len(ids), " ".join([decimal[i] for i in ids]), b"".join([pieces[i] for i in ids])

        encoder = Encoder(dictionary, ranks, pattern_, made)
        for batch in byte_batches(batches, "text"):
            rows = []
            for text in batch["text"].to_pylist():
                counts, ids, decoded = zip(*encoder.of_words(text)) if text else ((), (), ())
                rows.append((sum(counts), hashlib.sha256(" ".join(ids).encode()).hexdigest(), hashlib.sha256(b"".join(decoded)).hexdigest()))
            counts, of_ids, of_bytes = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
