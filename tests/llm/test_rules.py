import random
import re

import duckdb
import pytest

from sluiceway.llm import queries, rules_cascade
from sluiceway.llm.rules_cascade import RULES, Measures, count_repeated_words, first_reject


def naive_repeats(words):
    seen = {}
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i : i + 5]), []).append(i)
    return len({i + k for at in seen.values() if len(at) > 1 for i in at for k in range(5)})


@pytest.mark.parametrize("kinds", [1, 2, 5, 50, 40_000])
def test_repeated_words(kinds):
    rng = random.Random(kinds)
    for n in (0, 1, 4, 5, 6, 30, 3000):
        words = [b"%d" % rng.randrange(kinds) for _ in range(n)]
        words += words[: n // 3]
        assert count_repeated_words(words) == naive_repeats(words)


def test_measures():
    m = Measures("a b\x0b#c | é\n\na b\n x\n x\n")
    assert (m.n_words, m.word_chars, m.n_symbols, m.n_lines, m.n_dup_lines) == (9, 10, 2, 4, 1)
    assert Measures("A b\x1cc").n_words == 1  # only ASCII white space separates


def test_order_never_changes_the_verdict(odd_rows):
    rng = random.Random(1)
    orders = [rng.sample(list(RULES), len(RULES)) for _ in range(6)]
    for row in odd_rows:
        assert len({first_reject(Measures(row[1]), o) is None for o in orders}) == 1


def test_odd_rows(odd, odd_rows, empty):
    got = rules_cascade.measure(odd).collect()
    assert len(got) == len(odd_rows)
    by_id = {r.doc_id: r for r in got if r.doc_id}
    assert by_id[3].n_words == 0 and by_id[3].base_failed and not by_id[3].kept
    assert by_id[1].kept and by_id[9].kept and by_id[8].n_words == len(re.findall(r"[^\x20\x09-\x0D]+", odd_rows[10][1]))
    kept = rules_cascade.keep(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted(r.doc_id or 0 for r in got if r.kept)
    rejected = {r.doc_id: r.rejected_by for r in rules_cascade.judge(odd).collect() if r.doc_id}
    assert rejected[3] in ("few_words", "long_words") and rejected[1] is None
    assert rules_cascade.measure(empty).count() == 0 and rules_cascade.keep(empty).count() == 0


def test_estimated_order_has_every_rule(odd):
    assert sorted(rules_cascade.estimate_order(odd)) == sorted(RULES)


def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    df = queries.QUERIES["op9_quality_rules"](spark, sf)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.ORACLES['op9_quality_rules']})").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(want)


def test_base_against_plain_regex(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.QUERIES["op9_quality_rules"](spark, sf).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id])
        repeats = naive_repeats(words)
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(words), sum(map(len, words)), repeats)
        assert r.base_failed == (len(words) < 10 or 100 * repeats > 20 * len(words)) and not (r.base_failed and r.kept)


def test_sample_moves_no_text(spark, odd, odd_rows):
    """The order's sample is drawn in place: no exchange, and about as many rows as asked for."""
    assert rules_cascade.sample_texts(odd, rows=len(odd_rows)).count() == len(odd_rows)
    many = spark.range(0, 20_000, numPartitions=8).selectExpr("id as doc_id", "concat('text ', id) as text")
    few = rules_cascade.sample_texts(many)
    assert abs(few.count() - rules_cascade.SAMPLE_ROWS) < 150
    assert "Exchange" not in few._jdf.queryExecution().executedPlan().toString()
