"""Token counts from flat token files, by a scan for separators.

A token file is nothing but token ids of fixed width, an end-of-document id
after each document; it has no index. Blocks of it are searched on their own
for the separator, vectorised; a prefix scan over the block summaries (in two
levels, so that a file of any size is scanned by many tasks) then tells each
block how many documents ended before it and where the last one did, which
stitches documents that cross block boundaries.
"""

from __future__ import annotations

import base64
import re
import uuid
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ._shared import materialise, open_shared, remove_path, scratch_folder, small_batches

#: Tokens of a block; bytes after which a written file is closed.
BLOCK_TOKENS = 1 << 20
FILE_BYTES = 64 << 20
#: Documents after which a file is closed: its ids are one row.
FILE_ROWS = 1 << 17
#: Blocks that the lower level of the prefix scan holds together.
GROUP = 256
# Fixed value: how a text is cut before byte pairs are merged.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Blank runs of this length are taken out of a text: the pattern looks back
#: over a whole run, on the stack. The class is that of the pattern's \s.
LONG_BLANKS = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{4096,}")


def dtype_for(ids: int) -> np.dtype:
    return np.dtype("<u2" if ids <= 1 << 16 else "<u4")


@lru_cache(maxsize=2)
def encoder(path: str):
    """Byte-pair encoder of a ranks file: base64 token and rank per line."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(vocabulary: str, text: str) -> list[int]:
    """Ids of a text of any length.

    A long blank run is one piece of the pattern, but for its last character
    before a word, which starts the next piece or is one of its own; the text
    is cut there, so the ids are those of the whole text.
    """
    bpe, ids, at = encoder(vocabulary), [], 0
    for run in LONG_BLANKS.finditer(text):
        end = run.end() - (run.end() < len(text))
        ids += bpe.encode_ordinary(text[at : run.start()])
        ids += bpe._encode_single_piece(text[run.start() : end])
        at = end
    return ids + bpe.encode_ordinary(text[at:])


def _writer(folder: str, vocabulary: str, eod: int, file_bytes: int, file_rows: int):
    def run(batches):
        kind = dtype_for(eod + 1)
        out, name, ids, size = None, None, [], 0

        def row():
            return pd.DataFrame({"path": [name], "bytes": [size], "doc_ids": [ids]})

        for pdf in batches:
            for doc, text in zip(pdf["doc_id"], pdf["text"]):
                if out is None:
                    name, ids, size = f"{folder}/{uuid.uuid4().hex}.tokens", [], 0
                    out = open_shared(name, "wb")
                tokens = encode(vocabulary, text)
                tokens.append(eod)
                raw = np.array(tokens, dtype=kind).tobytes()
                out.write(raw)
                ids.append(None if pd.isna(doc) else int(doc))
                size += len(raw)
                if size >= file_bytes or len(ids) >= file_rows:
                    out.close()
                    out = None
                    yield row()
        if out is not None:
            out.close()
            yield row()

    return run


def write_token_files(documents: DataFrame, vocabulary: str, eod: int, folder: str | None = None, file_bytes: int = FILE_BYTES, file_rows: int = FILE_ROWS) -> DataFrame:
    """Encode ``documents`` (doc_id, text) to flat token files.

    Returns (path, bytes, doc_ids in file order), a table in the shared
    folder. A file is closed after ``file_bytes`` bytes or ``file_rows``
    documents, whichever comes first, so a row of the table is bounded. Null
    and empty texts are documents of no tokens; a very long text is encoded
    whole and may make its file longer. File names are
    drawn anew by each attempt of a task, so a repeated task leaves files that
    the table does not name. ``eod`` must be above every id of the vocabulary.
    """
    spark = documents.sparkSession
    small_batches(spark)
    folder = folder or scratch_folder(spark, "tokens")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return materialise(rows.mapInPandas(_writer(folder, vocabulary, eod, file_bytes, file_rows), "path string, bytes long, doc_ids array<long>"), "token-files")


def _search(eod: int, width: int, block_tokens: int):
    kind = np.dtype(f"<u{width}")

    def run(batches):
        for pdf in batches:
            for path, block in zip(pdf["path"], pdf["block"]):
                with open_shared(path, "rb") as stream:
                    stream.seek(int(block) * block_tokens * width)
                    raw = stream.read(block_tokens * width)
                ids = np.frombuffer(raw, dtype=kind)
                at = np.flatnonzero(ids == eod) + int(block) * block_tokens
                yield pd.DataFrame({"path": [path], "block": [block], "tokens": [len(ids)], "at": [at]})

    return run


def separator_scan(files: DataFrame, eod: int, width: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(path, ordinal, start, n_tokens, closed) of every document in ``files``
    (path, bytes): ordinals from 0 in file order, start in tokens.

    The separator itself is not counted. Tokens after the last separator are
    one more document that is not closed; a file without tokens has none. A
    byte count that is no multiple of the width is an error.
    """
    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    step = F.lit(block_tokens * width)
    sized = files.select("path", F.when(F.col("bytes") % width == 0, F.col("bytes")).otherwise(F.raise_error(F.lit("token file is cut inside a token"))).alias("bytes"))
    blocks = sized.where("bytes > 0").select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("bytes") / step) - 1)).alias("block"))
    found = blocks.repartition(parts, "path", "block").mapInPandas(_search(eod, width, block_tokens), "path string, block long, tokens long, at array<long>")
    found = materialise(found.withColumn("grp", F.floor(F.col("block") / GROUP)), "separators")

    summary = found.select("path", "grp", "block", F.size("at").alias("n"), F.when(F.size("at") > 0, F.element_at("at", -1)).alias("end"), "tokens")
    before = lambda *keys: W.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(W.unboundedPreceding, -1)
    upper = summary.groupBy("path", "grp").agg(F.sum("n").alias("n"), F.max("end").alias("end"))
    upper = upper.select("path", "grp", F.coalesce(F.sum("n").over(before("path", "grp")), F.lit(0)).alias("n0"), F.coalesce(F.max("end").over(before("path", "grp")), F.lit(-1)).alias("end0"))
    lower = summary.select("path", "grp", "block", F.sum("n").over(before("path", "grp", "block")).alias("n1"), F.max("end").over(before("path", "grp", "block")).alias("end1"))
    carry = lower.join(upper, ["path", "grp"]).select("path", "block", (F.col("n0") + F.coalesce("n1", F.lit(0))).alias("ended"), F.coalesce("end1", "end0").alias("last"))

    # Each separator beside the one before it, so an exploded row is two numbers.
    ends = F.arrays_zip(F.concat(F.array(F.col("last")), F.slice("at", F.lit(1), F.greatest(F.size("at") - 1, F.lit(0)))).alias("before"), F.col("at").alias("end"))
    rows = found.join(carry, ["path", "block"]).where(F.size("at") > 0).select("path", "ended", F.posexplode(ends).alias("k", "x"))
    start = F.col("x.before") + 1
    closed = rows.select("path", (F.col("ended") + F.col("k")).alias("ordinal"), start.alias("start"), (F.col("x.end") - start).alias("n_tokens"), F.lit(True).alias("closed"))
    whole = summary.groupBy("path").agg(F.sum("n").alias("ordinal"), F.coalesce(F.max("end"), F.lit(-1)).alias("end"), F.sum("tokens").alias("tokens"))
    open_ = whole.where("tokens > end + 1").select("path", "ordinal", (F.col("end") + 1).alias("start"), (F.col("tokens") - F.col("end") - 1).alias("n_tokens"), F.lit(False).alias("closed"))
    return closed.unionByName(open_)


def token_counts(documents: DataFrame, vocabulary: str, eod: int, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(doc_id, n_tokens) of every row of ``documents``, read off the flat
    files that the rows were written to. Null and empty texts have no tokens,
    very long ones are counted whole over several blocks. Repeated ids give
    repeated rows and a null id stays null; other columns are ignored,
    whatever their names. Ties do not occur: a document is its place in a
    file. An empty table gives no rows. The files are deleted once they have
    been scanned."""
    folder = scratch_folder(documents.sparkSession, "tokens")
    files = write_token_files(documents, vocabulary, eod, folder)
    scanned = separator_scan(files, eod, dtype_for(eod + 1).itemsize, block_tokens)
    remove_path(documents.sparkSession, folder)
    names = files.select("path", F.posexplode("doc_ids").alias("ordinal", "doc_id"))
    return scanned.join(names.withColumn("ordinal", F.col("ordinal").cast("long")), ["path", "ordinal"]).select("doc_id", "n_tokens")
