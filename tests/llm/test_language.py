import zlib

import numpy as np
from pyspark.sql import functions as F

from sluiceway.llm import language, queries
from sluiceway.llm.language import ByteNetwork, windows_of


def test_windows_hold_the_whole_text():
    for n in (1, 127, 128, 129, 1000):
        assert windows_of("x" * n).tobytes().rstrip() == b"x" * n


def test_gradient():
    """Backward step against finite differences."""
    rng = np.random.default_rng(0)
    net = ByteNetwork(["a", "b", "c"])
    rows, labels = rng.integers(97, 110, (6, language.WINDOW_BYTES)).astype(np.uint8), np.array([0, 1, 2, 0, 1, 2])
    for k, p in enumerate(net.parameters()):
        p64 = p.astype(np.float64)
        gradient = net.step(rows, labels)[1][k]
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        losses = []
        for sign in (1, -1):
            p[at] = p64[at] + sign * 1e-2
            losses.append(net.step(rows, labels)[0])
            p[at] = p64[at]
        assert abs((losses[0] - losses[1]) / 2e-2 - gradient[at]) <= 0.1 * abs(gradient[at]) + 1e-3


def test_tables_equal_the_network():
    rng = np.random.default_rng(1)
    net = ByteNetwork(["a", "b"])
    rows = rng.integers(32, 128, (5, language.WINDOW_BYTES)).astype(np.uint8)
    logs = net.fold().log_chances(rows)
    for k in range(2):
        assert abs(net.step(rows, np.full(5, k))[0] + logs[:, k].mean()) < 1e-4


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    langs = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.QUERIES["op8_language_id"](spark, sf).collect()
    assert len(rows) == len(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    right = [r.lang_pred == langs[r.doc_id][0] for r in rows if r.held_out]
    assert np.mean(right) >= 0.95
    assert all(0 <= r.score <= 1 for r in rows) and {r.lang_pred for r in rows} <= {"en", "de", "fr", "es", "und"}


def test_odd_rows(spark, odd, odd_rows, empty):
    got = language.identify(odd).collect()
    assert len(got) == len(odd_rows)
    assert all(r.lang_pred == "und" and r.score == 0 for r in got if r.doc_id in (3, 4, 6))
    assert language.identify(empty).count() == 0
    none = odd.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in language.identify(none).collect()} == {"und"}


def test_training_takes_a_repeated_id_once(spark, monkeypatch):
    monkeypatch.setattr(language, "PER_LANGUAGE", 5)
    repeated = spark.range(10_000).selectExpr("1L as doc_id", "concat('text ', id) as text", "if(id % 2 = 0, 'en', 'fr') as lang")
    others = spark.range(2, 300).selectExpr("id as doc_id", "concat('word', id) as text", "if(id % 3 = 0, 'fr', 'en') as lang")
    rows, names = language.training_windows(repeated.unionByName(others), "doc_id", "text", "lang", F.lit(True))
    assert len(rows) == 10 and sorted(names) == ["en"] * 5 + ["fr"] * 5 and len({r.tobytes() for r in rows}) == 10
    monkeypatch.setattr(language, "MOST_LANGUAGES", 1)
    assert set(language.training_windows(others, "doc_id", "text", "lang", F.lit(True))[1]) == {"en"}


def test_threshold_keeps_the_smallest_hashes(spark, monkeypatch):
    """The hash threshold before the ranking changes nothing in the sample."""
    monkeypatch.setattr(language, "PER_LANGUAGE", 100)
    rows = spark.range(3000).selectExpr("id as doc_id", "concat('w', id) as text", "if(id % 3 = 0, 'fr', 'en') as lang")
    got = {bytes(r).rstrip().decode() for r in language.training_windows(rows, "doc_id", "text", "lang", F.lit(True))[0]}
    ranked = sorted(rows.withColumn("h", F.xxhash64("doc_id")).collect(), key=lambda r: r.h)
    assert got == {r.text for x in ("fr", "en") for r in [r for r in ranked if r.lang == x][:100]}
