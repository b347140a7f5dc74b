"""Count tokens: lengths only, from batches of bounded size that the library encodes."""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestflow.llm.base import BLOCK_BYTES, blocks, fields, free_name, map_rows, utf8
from nestflow.llm.pieces import Memo, split

#: Text that the library encodes in one call.
BATCH_BYTES = 256 << 10


class Counter:
    """Token counts of texts by one tokenizer file.

    A ``.json`` file must be byte-level BPE without a prefix space: texts are split at the
    boundaries that such a tokenizer never joins over, and distinct parts are encoded in
    batches of even size in UTF-8. A ``.model`` file has no such boundaries: its texts are
    encoded whole.
    """

    def __init__(self, path: str):
        # Spark runs a task per core; the library's own threads would come on top.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._encode = lambda texts: model.encode(texts, num_threads=1)
            self.count = self._whole
        else:
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            encode = model.encode_batch_fast
            self._encode = lambda texts: encode(texts, add_special_tokens=False)
            self._memo = Memo(self._whole)
            self.count = self._by_parts

    def _whole(self, texts: list[str]) -> list[int]:
        counts: list[int] = []
        for start, end in blocks([t.encode() for t in texts], BATCH_BYTES):
            counts += map(len, self._encode(texts[start:end]))
        return counts

    def _by_parts(self, texts: list[str]) -> list[int]:
        found, each = split(texts, BATCH_BYTES)
        sums = map(sum, self._memo.of(found))
        return [sum(islice(sums, count)) for count in each]


@functools.lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    """The counter of a file, read once per Python worker."""
    return Counter(path)


def count_tokens(
    df: DataFrame, path: str, limit: int, text: str = "text"
) -> DataFrame:
    """The rows with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more tokens than that).

    ``path`` is a tokenizer file that all executors can read. Begin, end and added special
    tokens are not counted, nor is a text truncated; special strings inside a text count as
    the library takes them. A null text counts as empty: no bytes, no tokens. Columns of
    these three names are replaced, others stay as they are.
    """
    added = {"n_bytes": "bigint", "n_tokens": "bigint"}
    kept = [c for c in df.columns if c.lower() not in {*added, "over_limit"}]
    source = free_name(df, "counted_text")
    carried = df.select(*kept, df[text].alias(source))
    schema = ", ".join([*fields(df.select(*kept)), *(f"`{n}` {t}" for n, t in added.items())])

    def make():
        tokens = counter(path)

        def work(batch: pa.RecordBatch) -> Iterator[dict]:
            texts = utf8(batch.column(source))
            counts: list[int] = []
            for start, end in blocks(texts, BLOCK_BYTES):
                counts += tokens.count([t.decode() for t in texts[start:end]])
            yield {c: batch.column(c) for c in kept} | {
                "n_bytes": [len(t) for t in texts],
                "n_tokens": counts,
            }

        return work

    return map_rows(carried, schema, make).withColumn("over_limit", F.col("n_tokens") > limit)
