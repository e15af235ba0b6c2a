import zlib

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from repseq.llm import token_files as K


def brute(docs):
    """Whole texts, encoded one by one, in order of doc_id (nulls last)."""
    t = Tokenizer.from_file(K.vocabulary_path())
    out, start = [], 0
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is None, d[0] or 0, d[1] is not None, zlib.crc32((d[1] or "").encode()), d[1] or "")):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: r[1])


def test_documents(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert ordered(K.op6_token_files(spark, sf_dir).collect()) == brute(docs)


def test_odd_texts(spark, odd, empty, tmp_path):
    strange = ["it's we'll 'S don'T", "a b c　d", "é ́x ý", "<|endoftext|> a<|startoftext|>b", "#$%12ab34 x²ⅷ", "ſ ﬁ Ⅷ ǅ ΑΣ ΑΣ. İI", "x​z﻿\x1c\x85w", "日本語テキスト 한국어 ไทย"]
    more = spark.createDataFrame([(1000 + i, t, None, None, None) for i, t in enumerate(strange)], odd.schema)
    docs = odd.unionAll(more).selectExpr("*", "1 AS start", "'x' AS crc")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    made = K.write_token_files(docs, str(tmp_path / "a"), K.vocabulary_path(), length=16, batch=4, file_bytes=100_000)
    assert len(made.files) > 1
    assert ordered(K.read_token_files(spark, made).collect()) == want
    none = K.write_token_files(empty, str(tmp_path / "b"), K.vocabulary_path())
    assert K.read_token_files(spark, none).count() == 0


def test_rows_are_views_of_the_file_and_masks_mark_padding(tmp_path):
    stream = np.arange(1000, dtype=np.uint16)
    path = str(tmp_path / "x.arrow")
    with pa.OSFile(path, "wb") as sink:
        w = K.SequenceWriter(sink, np.uint16, length=16, batch=4)
        for piece in np.array_split(stream, 7):
            w.add(piece)
        w.close()
    with pa.memory_map(path) as source:
        before = pa.total_allocated_bytes()
        f = K.SequenceFile(source, 16, 4)
        for k in (0, 5, 61):
            ids, mask = f.row(k)
            assert ids.tolist() == stream[16 * k : 16 * k + 16].tolist() and all(mask.to_pylist())
            assert not ids.flags.owndata
        ids, mask = f.row(62)
        assert ids[:8].tolist() == stream[992:].tolist() and mask.to_pylist() == [True] * 8 + [False] * 8
        assert np.concatenate(list(f.ids(37, 500))).tolist() == stream[37:537].tolist()
        assert pa.total_allocated_bytes() - before < 4096
        del ids, mask, f
