import subprocess
import sys
from pathlib import Path

import corpus_pipeline as pipeline
from claimlens.session import staged_paths
from tests.llm.frames import SF, documents
from tests.llm.test_line_frequency import brute as lines_brute
from tests.llm.test_retrieval_packing import check, tokenizer  # noqa: F401
from tests.llm.test_token_group_join import brute as link_brute
from tests.llm.test_token_group_join import near_copies

ROOT = Path(__file__).resolve().parents[2]


def step(name):
    return dict(pipeline.STAGES)[name]


def test_order_of_stages():
    assert [name for name, _ in pipeline.STAGES] == ["toxicity", "language", "lines", "near_copies", "packing"]


def test_filters_keep_columns_and_most_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", "1 as score", "'x' as lang_pred")
    for name in ("toxicity", "language"):
        kept = step(name)(spark, docs, SF)
        assert kept.columns == docs.columns
        ids = [r.doc_id for r in kept.collect()]
        assert len(ids) == len(set(ids)) and 0.7 * docs.count() < len(ids) <= docs.count()


def test_lines(spark):
    rows = [(i, f"home\nown {i}" if i else None, "en", "s") for i in range(9)]
    found = step("lines")(spark, documents(spark, rows), SF)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    expected = [(k, t, "en", "s", None if t is None else len(t)) for k, t, _, _ in lines_brute(rows, 0.02, 3)]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


def test_copies_keep_their_article(spark):
    """Copies and near copies of an article are above a line's share; one whole article is left of each."""
    def article(name, changed=None):
        lines = [" ".join(f"{name}{i}x{j}" for j in range(20)) for i in range(20)]
        if changed is not None:
            lines[changed] += f" changed {changed}"
        return "\n".join(lines)

    texts = [article("a")] * 5 + [article("b")] + [article("b", c) for c in range(4)] + [article(f"c{i}") for i in range(20)]
    rows = [(i, f"home\n{text}", "en", "s") for i, text in enumerate(texts)]
    docs = step("lines")(spark, documents(spark, rows), SF)
    found = {r.doc_id: r.text for r in step("near_copies")(spark, docs, SF).collect()}
    assert found == {i: texts[i] for i in (0, 5, *range(10, 30))}


def test_texts_stay_where_they_are(spark):
    """Only rows that may have to go meet those that go, and the line stage writes no second copy of the texts."""
    rows = [(i, f"home\n{t}", "en", "s") for i, t in [*near_copies(72, 6), (900, "same"), (901, "same"), (901, "same")]]
    docs = spark.createDataFrame(documents(spark, rows).collect(), documents(spark, rows).schema)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = step("near_copies")(spark, docs, SF)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(r.doc_id for r in found.collect()).count(901) <= 1
        assert plan.startswith("Union") and "Filter NOT" in plan.split("Join")[0]
        before = len(staged_paths())
        step("lines")(spark, docs, SF)
        assert not [p for p in staged_paths(before) if "page-texts" in p]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_near_copies_leave_one_of_each_group(spark):
    rows = [*near_copies(72, 5), (500, None), (None, "a b c"), (None, "a b c"), (501, "x y"), (501, "x y"), (502, "")]
    found = step("near_copies")(spark, documents(spark, rows), SF)
    groups = {eval(k): c for k, _, c in link_brute(rows, 80, 5)}  # noqa: S307
    expected = [k for k, c in groups.items() if k is not None and k == c] + [None, None]
    assert sorted((r.doc_id for r in found.collect()), key=repr) == sorted(expected, key=repr)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_different_texts_of_one_id(spark):
    """A text that is a near copy of nothing stays, whatever else its doc_id names."""
    texts = {n: " ".join(f"{n}{i}" for i in range(60)) for n in "abc"}
    rows = [(1, texts["a"]), (2, texts["a"] + " more"), (2, texts["b"]), (3, texts["b"]), (3, texts["c"]), (3, texts["c"])]
    found = step("near_copies")(spark, documents(spark, rows), SF)
    assert sorted((r.doc_id, r.text) for r in found.collect()) == [(1, texts["a"]), (2, texts["b"]), (3, texts["c"])]


def test_empty_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, function in pipeline.STAGES:
        docs = function(spark, docs, SF)
        assert docs.collect() == []


def test_whole_run(spark, tokenizer):  # noqa: F811
    """The stages one by one give the rows of run(), which hold each remaining document once."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, function in pipeline.STAGES[:-1]:
        docs = function(spark, docs, SF)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    pieces = pipeline.run(spark, SF).collect()
    assert {p.doc_id for p in pieces} == {k for k, _ in rows}
    check(pieces, rows, tokenizer, 2048)


def test_entry_without_the_operators(tmp_path):
    """The registry imports where the operators' folders and the pipeline are taken out."""
    for name in ("catalog", "claimlens"):
        (tmp_path / name).mkdir()
        for path in (ROOT / name).rglob("*"):
            place = path.relative_to(ROOT)
            if path.is_file() and path.suffix != ".pyc" and "llm" not in place.parts:
                (tmp_path / place).parent.mkdir(parents=True, exist_ok=True)
                (tmp_path / place).write_bytes(path.read_bytes())
    (tmp_path / "__spark_entry__.py").write_bytes((ROOT / "__spark_entry__.py").read_bytes())
    code = "import __spark_entry__ as e; q = e.queries(); assert 'op5_tree_bpe' not in q and 'pipeline' not in q and len(q) > 150"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, timeout=120, env={"PATH": "/usr/bin:/bin"})
