import re
import zlib

import numpy as np
from layerloom.llm import sequence_files
from layerloom.llm.registry import BYTE_BPE, op8_sequence_files
from tests.llm.conftest import SF, texts_of
from pyspark.sql import functions as F
from tokenizers import Tokenizer


def expected(texts):
    code, start, rows = Tokenizer.from_file(BYTE_BPE), 0, []
    for doc, text in texts:
        ids = np.array(code.encode(text, add_special_tokens=False).ids + [0], "<u4")
        rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return rows


def test_whole_table(spark, documents):
    got = sorted(tuple(r) for r in op8_sequence_files(spark, SF).collect())
    assert got == expected(sorted(texts_of(documents)))


def test_random_access(spark, documents):
    """Every sequence of every shard, by its number, is the stream's."""
    manifest = sequence_files.write(documents, sequence_files.new_folder(spark), BYTE_BPE, sequence=64).collect()
    code, stream = Tokenizer.from_file(BYTE_BPE), []
    for _, text in sorted(texts_of(documents)):
        stream += code.encode(text, add_special_tokens=False).ids + [0]
    at = 0
    for shard in sorted(manifest, key=lambda r: r["shard"]):
        file = sequence_files.SequenceFile(shard["ids_file"], 64)
        assert len(file) == -(-shard["n_tokens"] // 64)
        flat = np.concatenate([file[k][0] for k in range(len(file))])
        mask = np.concatenate([file[k][1] for k in range(len(file))])
        n = shard["n_tokens"]
        assert flat[:n].tolist() == stream[at : at + n] and mask[:n].all() and not mask[n:].any() and not flat[n:].any()
        assert flat.dtype == np.uint16 and not file.column(0).flags.owndata
        at += n
    assert at == len(stream)


def test_odd_and_empty(spark, odd, none):
    found = sequence_files.read(sequence_files.write(odd, sequence_files.new_folder(spark), BYTE_BPE)).collect()
    want = expected(texts_of(odd))
    assert sorted((r["n_tokens"], r["ids_crc32"]) for r in found) == sorted(w[2:] for w in want)
    ordered = sorted(found, key=lambda r: r["start"])
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in ordered]
    assert ids == sorted(ids)
    assert [r["start"] for r in ordered] == [0, *np.cumsum([r["n_tokens"] for r in ordered])[:-1].tolist()]
    assert sequence_files.read(sequence_files.write(none, sequence_files.new_folder(spark), BYTE_BPE)).count() == 0


def test_a_task_for_each_shard(spark, documents):
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")
    manifest = sequence_files.write(documents, sequence_files.new_folder(spark), BYTE_BPE)
    spark.conf.unset(merge)
    assert manifest.count() == 8
    read = sequence_files.read(manifest).withColumn("task", F.spark_partition_id())
    assert re.search(r"rangepartitioning\(shard\S* ASC NULLS FIRST, 8\), REPARTITION_BY_NUM", read._jdf.queryExecution().toString())


def test_a_batch_is_fetched_once(spark, documents, monkeypatch):
    manifest = sequence_files.write(documents, sequence_files.new_folder(spark), BYTE_BPE, sequence=64).collect()
    file = sequence_files.SequenceFile(manifest[0]["ids_file"], 64)
    fetched, reader = [], file.reader

    class Counting:
        def get_batch(self, k):
            fetched.append(k)
            return reader.get_batch(k)

    file.reader = Counting()
    for start in range(0, manifest[0]["n_tokens"] - 50, 50):
        assert sum(map(len, file.span(start, 50))) == 50
    assert fetched == sorted(set(fetched))
