import corpus_pipeline as cp
from cohortlink.llm import toxicity
from cohortlink.llm.queries import ORACLE, QUERIES

from .cases import SCHEMA, clashing, edge_rows, rows
from .test_decontaminate import brute as brute_items
from .test_jaccard_join import brute as brute_components
from .test_line_dedup import brute as brute_lines

SF = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    for step, (name, stage) in enumerate(cp.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        after = {r.doc_id: r for r in out.collect()}
        pairs = [(i, r.text) for i, r in before.items()]
        if step < 4:
            assert out.columns == names
        if step == 0:
            model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            assert set(after) == {r.doc_id for r in toxicity.score(docs, model).where("predicted = 0").collect()}
        if step == 1:
            lost = {i: n for i, _, n, _ in brute_lines(pairs, equal_chars=1)}
            assert all(before[i].text == after[i].text for i in after if not lost[i])
            assert all(after[i].n_chars == len(after[i].text) for i in after if lost[i])
            assert all(lost[i] for i in set(before) - set(after))
        if step == 2:
            assert set(after) == {i for i, _, c in brute_components(pairs) if i == c}
        if step == 3:
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert set(after) == set(before) - {r[0] for r in brute_items(pairs, items)}
        if step == 4:
            assert set(after) == set(before) and all(0 <= r.taken <= 2 * r.size for r in after.values())
            taken, target = {}, {}
            for i, r in after.items():
                taken[before[i].source] = taken.get(before[i].source, 0) + r.taken
                target[before[i].source] = r.target
            assert all(abs(taken[k] - target[k]) <= 0.05 * target[k] + 40 for k in target)  # few documents a source here
        docs = out
    assert rows(cp.run(spark, SF)) == rows(docs)


def test_stages_take_edges_and_clashing_names(spark, rng, tmp_path):
    df = clashing(spark.createDataFrame(edge_rows(rng), SCHEMA))
    for _, stage in cp.STAGES[:4]:
        out = stage(spark, df, SF)
        assert out.columns == df.columns and 0 < out.count() <= 12
        assert stage(spark, df.limit(0), SF).count() == 0
    assert cp.STAGES[4][1](spark, df, SF).count() == 12


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)
