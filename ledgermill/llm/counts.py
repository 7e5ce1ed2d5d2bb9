"""Token counts of whole texts behind a digest cache.

The cache is a table of (tokenizer version, content digest, number of tokens) in a shared folder.
A text's digest is that of its normalised content, in which only what cannot change the count is
made alike; a version is the digest of the tokenizer's file, library and normalisation. Texts'
digests are joined with the cache first. Of what the cache lacks, each distinct content is encoded
once, where its row lies: the rows to encode are written down by input file and the tasks that read
the files again look them up, so texts are never shuffled. New counts are appended to the cache and
all rows take theirs from it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from importlib.metadata import version as library_version

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as pads
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm import files
from ledgermill.llm.common import BLANK, anchored, arrow, shared_copy
from ledgermill.operators.tables import table_exists
from ledgermill.workspace import new_path, stage

LIMIT = 2048
#: Words, and bytes of a word, that a worker keeps the counts of; others are counted anew.
WORDS, WORD_BYTES = 400_000, 64
#: Folders that the rows to encode are dealt to by input file, at most.
PARTS = 4096
#: Rows of an input file whose marks a task holds at a time.
SPAN = 1 << 18
#: Changes whenever ``normal`` does.
NORMALISATION = 1
#: How a vocabulary says that white space only separates words, and no word's tokens
#: depend on another word.
_WORDWISE = {
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
                    {"type": "Lowercase"}],
    "pretokenizers": [
        {"type": "Split", "pattern": {
            "Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}],
}

#: What a special string has in it where ``normal`` is to tell texts that may hold one.
SPECIAL = "<|"
CACHE = "digest binary, n_tokens long"


def default_tokenizer() -> str:
    """Where the public 49k vocabulary lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def wordwise(spec: dict) -> bool:
    """Whether a tokenizers file's counts are sums over words between ASCII blanks, and ASCII texts
    without ``SPECIAL`` have the same count in lower case."""
    steps = {name: (spec.get(key) or {}).get(name) for key, name in (
        ("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))}
    plain = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"])
                and len(t["content"].split()) == 1 and SPECIAL in t["content"] for t in spec["added_tokens"])
    return steps == _WORDWISE and plain and not spec.get("post_processor")


class Counter:
    """Counts as the library for a file's kind does: tokenizers for .json, sentencepiece for .model.

    No begin, end or other special tokens are added; special strings in a text are handled as the
    library does by default; nothing is truncated or padded.
    """

    def __init__(self, uri: str):
        content = files.content(uri)
        self.words: dict[bytes, int] | None = None
        if uri.endswith(".json"):
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_buffer(content)
            self.tokenizer.no_truncation()
            self.tokenizer.no_padding()
            if wordwise(json.loads(content)):
                self.words = {}
        elif uri.endswith(".model"):
            from sentencepiece import SentencePieceProcessor

            self.tokenizer = SentencePieceProcessor(model_proto=content)
        else:
            raise ValueError(f"no library for {uri}")

    def whole(self, text: str) -> int:
        if hasattr(self.tokenizer, "encode_batch"):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return len(self.tokenizer.encode(text, num_threads=1))

    def count(self, text: bytes) -> int:
        """Tokens of a text in UTF-8."""
        if self.words is None:
            return self.whole(text.decode("utf-8", "replace"))
        total, known = 0, self.words
        for word in text.split():  # of bytes: at the six ASCII blanks
            n = known.get(word)
            if n is None:
                n = self.whole(word.decode("utf-8", "replace"))
                if len(word) <= WORD_BYTES:
                    if len(known) >= WORDS:
                        known.clear()
                    known[word] = n
            total += n
        return total


@lru_cache(maxsize=2)
def counter(uri: str) -> Counter:
    """One counter for each tokenizer and Python worker."""
    return Counter(uri)


def tokenizer_version(path: str) -> str:
    """Digest of all that a count depends on beside the content."""
    library = "tokenizers" if path.endswith(".json") else "sentencepiece"
    with open(path, "rb") as file:
        content = file.read()
    said = f"{library} {library_version(library)} {NORMALISATION} "
    return hashlib.sha256(said.encode() + content).hexdigest()


def normal(text: Column, by_words: bool) -> Column:
    """Content that has the count of ``text``; null is empty.

    Where only words count, runs of ASCII blanks are one space and ASCII texts are in lower case,
    but for those that may hold a special string. Other tokenizers see every character.
    """
    text = F.coalesce(text, F.lit(""))
    if not by_words:
        return text
    blanks = F.trim(F.regexp_replace(text, f"{BLANK}+", " "))
    plain = (F.octet_length(text) == F.char_length(text)) & ~F.contains(text, F.lit(SPECIAL))
    return F.when(plain, F.lower(blanks)).otherwise(blanks)


def cached(spark: SparkSession, folder: str) -> DataFrame:
    """The counts stored for one tokenizer version; an entry may be there more than once."""
    if table_exists(spark, folder):
        return spark.read.schema(CACHE).parquet(folder)
    return spark.createDataFrame([], CACHE)


def _mark(misses: DataFrame, anchor: list[str]) -> str:
    """Write the rows to encode, sorted by file and place in it, and return where.

    A file's rows lie in one folder, so a task that reads the file again finds them without
    looking through all others; small row groups make places skippable.
    """
    path = new_path(misses.sparkSession, "to-encode")
    file, row = anchor
    (misses.withColumn("part", F.pmod(F.crc32(F.col(file).cast("binary")), F.lit(PARTS)))
     .hint("rebalance", "part").sortWithinPartitions("part", file, row)
     .select("part", F.col(file).alias("file"), F.col(row).alias("row"), "digest")
     .write.partitionBy("part").option("parquet.block.size", 4 << 20).parquet(path))
    return path


class Marks:
    """Of one input file, the rows to encode and their digests, a span of rows at a time."""

    def __init__(self, path: str, part: int, file: str):
        fs, folder = files.resolve(f"{path}/part={part}")
        self.there = fs.get_file_info(folder).type.name == "Directory"
        if self.there:
            self.table, self.file = pads.dataset(folder, filesystem=fs, format="parquet"), file
        self.span, self.rows, self.digests = -1, np.empty(0, np.int64), pa.array([], pa.binary())

    def among(self, rows: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
        """Of ascending rows of one span, the places of those to encode, and their digests."""
        if not self.there:
            return np.empty(0, np.int64), []
        span = int(rows[0]) // SPAN
        if span != self.span:
            wanted = ((pads.field("file") == self.file) & (pads.field("row") >= span * SPAN)
                      & (pads.field("row") < (span + 1) * SPAN))
            found = self.table.to_table(columns=["row", "digest"], filter=wanted, use_threads=False)
            found = found.sort_by("row").combine_chunks()
            self.span, self.rows = span, found.column("row").to_numpy()
            self.digests = found.column("digest").combine_chunks()
        places = np.flatnonzero(np.isin(rows, self.rows, assume_unique=True))
        return places, self.digests.take(np.searchsorted(self.rows, rows[places])).to_pylist()


def encode_marked(rows: DataFrame, anchor: list[str], marks: str, uri: str) -> DataFrame:
    """(digest, n_tokens) of the rows that were written down, each in the task that reads it."""
    file, row = anchor
    seen = rows.select(F.col("text").cast("string").cast("binary").alias("text"),
                       F.pmod(F.crc32(F.col(file).cast("binary")), F.lit(PARTS)).cast("int").alias("part"),
                       F.col(file).alias("file"), F.col(row).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, found, coder = None, None, counter(uri)
        for batch in batches:
            places = batch.column(3).to_numpy()
            # Runs of one file and one span; a scan gives a file's rows in their order.
            owner = pc.dictionary_encode(batch.column(2)).indices.to_numpy()
            cut = np.flatnonzero((np.diff(owner) != 0) | (np.diff(places // SPAN) != 0)) + 1
            digests, counts = [], []
            for begin, end in zip([0, *cut], [*cut, len(places)]):
                if begin == end:
                    continue
                if (this := batch.column(2)[begin].as_py()) != name:
                    name, found = this, Marks(marks, batch.column(1)[begin].as_py(), this)
                chosen, own = found.among(places[begin:end])
                digests += own
                counts += [coder.count(batch.column(0)[begin + int(k)].as_py() or b"") for k in chosen]
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.binary()), pa.array(counts, pa.int64())], names=["digest", "n_tokens"])

    return seen.transform(arrow, run, CACHE)


def token_counts(docs: DataFrame, tokenizer: str | None = None, cache: str | None = None,
                 limit: int = LIMIT) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` of every row of ``docs``.

    ``cache`` is a folder that keeps counts between calls and applications; without one the cache
    is new and starts empty. Whoever appends the same content at the same time stores the same
    count, which then is there twice and does no harm; what an interrupted call appended is used
    by the next. Null text counts as empty: no bytes and no tokens. A very long text is counted
    word by word where the vocabulary allows it, else whole. Repeated and null ids come out as they
    came in, equal texts are encoded once, other columns are not read, and an empty table gives an
    empty one.
    """
    spark = docs.sparkSession
    path = tokenizer or default_tokenizer()
    uri = shared_copy(spark, path)
    by_words = counter(uri).words is not None
    folder = f"{cache or new_path(spark, 'token-cache')}/version={tokenizer_version(path)}"
    rows, anchor = anchored(docs.select("doc_id", "text"))
    text = F.col("text").cast("string")
    marked = stage(rows.select(
        "doc_id", F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        F.unhex(F.sha2(normal(text, by_words), 256)).alias("digest"), *anchor), "digests")
    wanted = stage(marked.groupBy("digest").agg(F.min(F.struct(*anchor)).alias("at")), "distinct")
    misses = stage(wanted.join(cached(spark, folder), "digest", "left_anti").select(
        "digest", *(F.col("at")[a].alias(a) for a in anchor)), "misses")
    if not misses.isEmpty():
        marks = _mark(misses, anchor)
        encode_marked(rows, anchor, marks, uri).write.mode("append").parquet(folder)
        spark.catalog.refreshByPath(folder)
    known = stage(cached(spark, folder).join(wanted.select("digest"), "digest", "left_semi")
                  .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "known")
    return marked.join(known, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
