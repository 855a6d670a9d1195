"""op2 and op7 against a plain loop over the fitted model, every whole text of a table."""

import math
import re
import zlib

import pytest
import zstandard

from memberlens.llm import queries as Q
from memberlens.llm.common import table
from memberlens.llm.quality import fit_quality, training_rows
from memberlens.llm.toxicity import fit_toxicity

SF = "/root/testdata/sf0.01"                # enough toxic rows for three grades
EDGE = ".,;:!?\"'()[]{}|*%$&#<>/\\-_=+~`^@"


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) >= 1000 and max(len((r.text or "").split()) for r in rows) > 300          # whole long texts are compared too
    return {r.doc_id: r.text or "" for r in rows}


def test_toxicity_query_equals_a_plain_loop(spark, texts):
    model = fit_toxicity(table(spark, SF, "documents").select("doc_id", "text"), table(spark, SF, "labels"), where=training_rows("doc_id"))
    got = Q.op2_toxicity(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts) and len(model["cuts"]) == 2 and model["cuts"][0] < model["cuts"][1]
    assert {r.toxic for r in got} == {0, 1}
    for r in got:
        ids = set()
        for word in texts[r.doc_id].lower().split():
            word = re.sub(f"^[{re.escape(EDGE)}]+|[{re.escape(EDGE)}]+$", "", word)
            parts = ["w" + word] + ["p" + word[:n] for n in (4, 5, 6) if len(word) >= n]
            ids |= {zlib.crc32(p.encode()) % 2 ** 20 for p in parts} if word else set()
        z = math.fsum(model["weights"].get(i, 0.0) for i in ids)
        above = [1 / (1 + math.exp(-max(-30.0, min(30.0, z - cut)))) for cut in model["cuts"]]
        assert r.severity == pytest.approx(sum(above), abs=1e-6) and r.p_toxic == pytest.approx(above[0], abs=1e-6)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        if abs(above[0] - model["decision"]) > 1e-6:
            assert r.toxic == int(above[0] >= model["decision"])


def test_quality_query_equals_a_plain_loop(spark, texts):
    model = fit_quality(table(spark, SF, "documents").select("doc_id", "text"), table(spark, SF, "labels"))
    packers = [zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(model[c], dict_type=zstandard.DICT_TYPE_RAWCONTENT), level=3,
                                        write_content_size=False, write_checksum=False, write_dict_id=False) for c in ("bad", "good")]
    got = Q.op7_quality(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        data, size = texts[r.doc_id].encode(), [0, 0]
        while data:
            block, data = data[:2048], data[2048:]
            size = [n + len(p.compress(block)) for n, p in zip(size, packers)]
        x = (size[0] - size[1]) / (len(texts[r.doc_id].encode()) + 1)
        score = 1 / (1 + math.exp(-(model["slope"] * x + model["offset"])))
        assert r.score == pytest.approx(score, abs=1e-9) and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
