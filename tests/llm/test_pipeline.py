"""The pipeline against the brute-force versions of its stages, and its registration."""

import pytest
from llm_helpers import rows_of
from test_decontaminate import brute_leaks
from test_dedup import brute_lines, plain_fingerprint, roots
from test_tokens import check_packing

import __spark_entry__ as driver
import corpus_pipeline
from flowgauge.llm import quality
from flowgauge.llm.common import table

SF = "/root/testdata/sf0.001"
OPERATORS = ("simhash token_counts secret_scan url_filter exact_dedup quality_classifier best_fit_packing toxicity "
             "decontaminate line_dedup").split()  # fmt: skip


def test_every_operator_is_registered():
    names = driver.queries()
    assert {f"op{i + 1}_{name}" for i, name in enumerate(OPERATORS)} | {"pipeline"} <= set(names)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of every stage, each written and read again."""
    docs, out = table(spark, SF, "documents"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        stage(spark, docs, SF).write.parquet(path)
        out.append((docs, spark.read.parquet(path)))
        docs = out[-1][1]
    return out


def pairs(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_quality_stage(spark, stages):
    before, after = stages[0]
    good = quality.quality_scores(before, table(spark, SF, "labels")).filter("predicted = 1")
    assert rows_of(after, "doc_id") == rows_of(good, "doc_id")
    assert after.join(before, before.columns, "left_anti").count() == 0
    assert 0.5 * before.count() < after.count() < before.count()


def test_line_stage(stages):
    before, after = stages[1]
    wanted = {i: text for i, _, _, text in brute_lines(pairs(before))}
    assert dict(pairs(after)) == wanted
    assert after.columns == before.columns and after.filter("n_chars <> char_length(text)").count() == 0
    assert rows_of(after, "doc_id", "lang", "source") == rows_of(before, "doc_id", "lang", "source")


def test_near_duplicate_stage(stages):
    before, after = stages[2]
    rows = sorted(pairs(before))
    prints = [plain_fingerprint(text) for _, text in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    group = roots(len(rows), links)  # rows are sorted: the smallest index has the smallest id
    assert sorted(pairs(after)) == [row for i, row in enumerate(rows) if group[i] == i]
    assert after.columns == before.columns


def test_benchmark_stage(spark, stages):
    before, after = stages[3]
    held = {i for i, *_ in brute_leaks(pairs(before), pairs(table(spark, SF, "benchmark").withColumnRenamed("item_id", "doc_id")))}
    assert sorted(pairs(after)) == sorted((i, t) for i, t in pairs(before) if i not in held)
    assert after.columns == before.columns


def test_packing_stage(stages):
    before, after = stages[4]
    check_packing(pairs(before), after, 4096)


def test_run_applies_all_stages(spark, stages):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert rows_of(corpus_pipeline.run(spark, SF), *columns) == rows_of(stages[4][1], *columns)
    assert rows_of(driver.queries()["pipeline"](spark, SF), *columns) == rows_of(stages[4][1], *columns)


def test_odd_rows_go_through_all_stages(spark, make):
    rows = [(i, f"line number {i} stands here alone\nand another one, {i * 7}") for i in range(30)]
    rows += [(100, None), (101, ""), (None, "no id"), (3, rows[3][1]), (102, "x " * 50_000)]
    for docs in (make(rows), make([])):
        columns, n = docs.columns, docs.count()
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == columns and docs.count() <= n
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        assert packed.count() >= docs.count()
