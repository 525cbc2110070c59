import random
from datetime import datetime
from decimal import Decimal

import pytest

from claimlens import session
from claimlens.operators import load
from claimlens.plans import jobs
from claimlens.sources import database, files, snapshots
from claimlens.sources.warehouse import SCHEMAS, declared, from_parquet
from tests.micro import Micro


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_delimiters_of_many_files(spark, tmp_path):
    write(tmp_path / "d/semi.csv", "a;b;c\n1;2;3\n4;5,5;6\n")
    write(tmp_path / "d/comma.csv", 'a,b\n"x,y",2\n3,4\n')
    write(tmp_path / "d/pipe.csv", "a|b\n1|2 3\n")
    write(tmp_path / "d/none.csv", "abc\ndef\n")
    write(tmp_path / "d/late.csv", "a;b\n" * 5000 + "broken\n")
    got = {r.archivo.rsplit("/", 1)[1]: r.delimitador for r in files.detect_delimiters(spark, str(tmp_path / "d")).collect()}
    assert got == {"semi.csv": ";", "comma.csv": ",", "pipe.csv": "|", "none.csv": "error", "late.csv": "error"}


def test_delimiters_of_records_across_lines(spark, tmp_path):
    write(tmp_path / "d/breaks.csv", 'a;b\n1;"two\nlines; and ""more""\n"\n"x\n";3\n')
    write(tmp_path / "d/comma.csv", '"a\n;;\n;",b\n1,"\n"\n')
    write(tmp_path / "d/odd.csv", 'a|b\n5" pipe|2\n3|4\n')  # quotes that are no pairs: line by line
    write(tmp_path / "d/whole.csv", '"one\nvalue"\n"and\nanother"\n')
    got = {r.archivo.rsplit("/", 1)[1]: r.delimitador for r in files.detect_delimiters(spark, str(tmp_path / "d")).collect()}
    assert got == {"breaks.csv": ";", "comma.csv": ",", "odd.csv": "|", "whole.csv": "error"}


def plain_records(text):
    """Lines of a file put together while a quote is open."""
    found, open_ = [], False
    for line in text.split("\n"):
        found = [*found[:-1], found[-1] + "\n" + line] if open_ else [*found, line]
        open_ ^= line.count('"') % 2 == 1
    return found


@pytest.mark.parametrize("split", ["128m", "37b"])
def test_records_of_files_in_many_splits(spark, tmp_path, split):
    """Parity is carried from split to split: however a file is cut, its records are the same."""
    rng, expected = random.Random(7), {}
    for name in ("a", "b", "c"):
        values = ["".join(rng.choice(['x', ';', '\n', '""', ' ']) for _ in range(rng.randrange(12))) for _ in range(60)]
        text = "\n".join([f'{i};"{v}"' for i, v in enumerate(values)])
        write(tmp_path / f"d/{name}.csv", text + "\n")
        expected[f"{name}.csv"] = plain_records(text)
    with_split = spark.newSession()
    with_split.conf.set("spark.sql.files.maxPartitionBytes", split)
    with_split.conf.set("spark.sql.files.openCostInBytes", "0")
    found = {}
    for r in sorted(files.records(with_split, str(tmp_path / "d")).collect(), key=lambda r: (r.archivo, r.registro)):
        found.setdefault(r.archivo.rsplit("/", 1)[1], []).append(r.texto)
    assert found == expected


def test_values_of_records_across_lines(spark, tmp_path):
    write(tmp_path / "d/a.csv", 'k;v;n\n1;"two\n\nlines; ""q""";5\n\n2;plain;\n3;"";7\n')
    write(tmp_path / "d/b.csv", "k;v;n\n")
    rows = files.read_records(spark, str(tmp_path / "d"), "k int, v string, n int").collect()
    assert sorted((r.k, r.v, r.n) for r in rows) == [(1, 'two\n\nlines; "q"', 5), (2, "plain", None), (3, None, 7)]


def test_snapshots_keep_each_other_and_the_newest_is_read(spark, tmp_path):
    root = str(tmp_path / "s")
    for when, rows in (("20250106_0900", 3), ("20250203_1430", 5), ("20250106_0900", 4)):
        snapshots.save_snapshot(spark.range(rows), root, when)
    assert snapshots.latest_snapshot(spark, root) == "20250203_1430"
    assert snapshots.read_latest(spark, root).count() == 5
    counts = {r.snapshot: r["count"] for r in snapshots.read_snapshots(spark, root).groupBy("snapshot").count().collect()}
    assert counts == {"20250106_0900": 4, "20250203_1430": 5}
    assert all("20250203_1430" in f for f in snapshots.read_latest(spark, root).inputFiles())


def test_newest_snapshot_may_be_empty(spark, tmp_path):
    root = str(tmp_path / "s")
    snapshots.save_snapshot(spark.range(5), root, "20250106_0900")
    snapshots.save_snapshot(spark.range(5).limit(0), root, "20250203_0900")
    assert snapshots.latest_snapshot(spark, root) == "20250203_0900"
    assert snapshots.read_latest(spark, root).collect() == []
    (tmp_path / "s/snapshot=20250301_0900").mkdir()  # a writer that has not finished
    assert snapshots.latest_snapshot(spark, root) == "20250203_0900"
    with pytest.raises(FileNotFoundError):
        snapshots.latest_snapshot(spark, str(tmp_path / "none"))


def test_bundle_has_one_stamp(spark, tmp_path):
    root = str(tmp_path)
    for when, names in (("20250106_0900", snapshots.BUNDLE), ("20250203_0900", ["dataset"])):
        for name in names:
            rows = spark.createDataFrame([(1, f"{name}{when}")], "uniqueid int, v string")
            snapshots.save_snapshot(rows, f"{root}/prepared/{name}", when)
    assert snapshots.latest_bundle(spark, root) == "20250106_0900"
    assert snapshots.read_bundle(spark, root)["dataset"].first().v == "dataset20250106_0900"


def tables(spark, text):
    return {name: spark.createDataFrame([(1, f"{name} {text}")], "uniqueid int, v string") for name in snapshots.BUNDLE}


def values(spark, root):
    return {name: df.first().v for name, df in snapshots.read_bundle(spark, root).items()}


def test_a_rerun_takes_effect_at_once_or_not_at_all(spark, tmp_path):
    root, when = str(tmp_path), "20250203_0900"
    with pytest.raises(FileNotFoundError):
        snapshots.read_bundle(spark, root)
    for text in ("first", "second"):
        snapshots.save_tables(tables(spark, text), root, when)
        assert values(spark, root) == {name: f"{name} {text}" for name in snapshots.BUNDLE}
    broken = tables(spark, "third")
    broken["variables"] = broken["variables"].selectExpr("raise_error('stopped') as uniqueid", "v")
    with pytest.raises(Exception, match="stopped"):
        snapshots.save_tables(broken, root, when)
    assert values(spark, root)["dataset"] == "dataset second"
    snapshots.save_tables(tables(spark, "older"), root, "20250106_0900")
    assert snapshots.latest_bundle(spark, root) == when and values(spark, root)["dataset"] == "dataset second"


def test_a_bundle_does_not_need_the_writers_marker(spark, tmp_path):
    """Some stores are told to leave none."""
    snapshots.save_tables(tables(spark, "only"), str(tmp_path), "20250203_0900")
    for marker in tmp_path.rglob("_SUCCESS"):
        marker.write_text("")
        marker.replace(marker.with_name("_gone"))
    assert values(spark, str(tmp_path))["information"] == "information only"


def test_bundles_from_before_manifests_are_read(spark, tmp_path):
    root = str(tmp_path)
    for name, df in tables(spark, "plain").items():
        snapshots.save_snapshot(df, f"{root}/prepared/{name}", "20250106_0900")
    assert values(spark, root)["dataset"] == "dataset plain"
    snapshots.save_tables(tables(spark, "run"), root, "20250106_0900")
    assert values(spark, root)["dataset"] == "dataset run"


def test_a_name_is_given_once(spark, tmp_path):
    snapshots.write_file(spark, str(tmp_path / "f/a.json"), "é")
    with pytest.raises(FileExistsError):
        snapshots.write_file(spark, str(tmp_path / "f/a.json"), "b")
    assert (tmp_path / "f/a.json").read_text() == "é"


def test_names_and_stamps():
    assert snapshots.newest(["dataset_20250106_0900", "dataset_20250203_1430", "other_9"], "dataset").endswith("1430")
    with pytest.raises(FileNotFoundError):
        snapshots.newest(["a"], "b")
    assert snapshots.stamp(datetime(2025, 2, 3, 14, 30, 40)) == "20250203_1430"


FIELDS = "Id;INT;int\nMonto;DECIMAL(10,2);float\nFecha;DATETIME;datetime\nGlosa;VARCHAR(3);str\n"
AUDIT = "UsuarioModificacion;VARCHAR(20);str\nFechaModificacion;DATETIME;datetime\nFechaCreacion;DATETIME;datetime\n"


@pytest.fixture
def definition(spark, tmp_path):
    write(tmp_path / "tables/pagos/campos.txt", FIELDS + AUDIT)
    write(tmp_path / "tables/pagos/paths.txt", "destino; db\n".replace("; ", ";"))
    write(tmp_path / "tables/configs.txt", "USER;tester\n")
    header = "Id;Monto;Fecha;Glosa;UsuarioModificacion;FechaModificacion;FechaCreacion\n"
    write(tmp_path / "tables/pagos/data.csv", header + "2.5;0.125;2024-01-02 03:04:05;abcd;;;\n")
    return files.read_table_definition(spark, str(tmp_path / "tables/pagos"), read_data=True)


def test_table_definition(definition):
    assert definition["paths"] == {"destino": "db"} and definition["configs"] == {"USER": "tester"}
    assert definition["campos"]["Monto"] == {"sqltype": "DECIMAL(10,2)", "pytype": "float"}
    assert list(definition["campos"])[:4] == ["Id", "Monto", "Fecha", "Glosa"]


def test_load_preparation(definition):
    now = datetime(2024, 7, 1, 10, 0, 0, 999)
    created, types = load.prepare_load(definition["data"], definition["campos"], definition["configs"], "create", now)
    (row,) = created.collect()
    assert tuple(row) == (
        2, Decimal("0.12"), datetime(2024, 1, 2, 3, 4, 5), "abc", "tester",
        datetime(2024, 7, 1, 10), datetime(2024, 7, 1, 10),
    )
    assert types.startswith("Id INT, Monto DECIMAL(10,2), Fecha DATETIME, Glosa VARCHAR(3)")
    updated, types = load.prepare_load(definition["data"], definition["campos"], definition["configs"], "update", now)
    assert "FechaCreacion" not in updated.columns and "FechaCreacion" not in types
    with pytest.raises(ValueError, match="valid mode"):
        load.prepare_load(definition["data"], definition["campos"], definition["configs"], "other")


def test_column_types():
    assert [load.spark_type(t) for t in ("INT", "DECIMAL(10,2)", "DATETIME", "VARCHAR(7)")] == [
        "int", "decimal(10,2)", "timestamp", "string",
    ]
    with pytest.raises(ValueError):
        load.spark_type("BLOB")


def test_load_methods(spark, tmp_path):
    rows, path = spark.range(3), str(tmp_path / "t")
    database.load_table(rows, "fail", "claimlens_methods", path)
    database.load_table(rows, "append", "claimlens_methods", path)
    assert spark.table("claimlens_methods").count() == 6
    database.load_table(rows, "replace", "claimlens_methods", path)
    assert database.preview(spark, "claimlens_methods").count() == 3
    with pytest.raises(Exception, match="already exists"):
        database.load_table(rows, "fail", "claimlens_methods", path)
    with pytest.raises(ValueError, match="valid method"):
        database.save_mode("upsert")


def test_jdbc_options():
    options = database.jdbc_options("jdbc:x", ["db", "dbo", "t"], "Id INT", chunks=500, connections=8)
    assert options == {
        "url": "jdbc:x", "dbtable": "[db].[dbo].[t]", "createTableColumnTypes": "Id INT", "batchsize": "500", "numPartitions": "8",
    }


def test_named_outputs(spark, tmp_path):
    paths = snapshots.save_frames([spark.range(2), spark.range(3)], str(tmp_path))
    assert [p.rsplit("/", 1)[1] for p in paths] == ["sheet0", "sheet1"]
    (path,) = snapshots.save_frames({"hoja": spark.range(4)}, str(tmp_path), fmt="csv")
    assert spark.read.option("header", True).csv(path).count() == 4


def test_parquet_warehouse(spark, tmp_path):
    wh = Micro()
    wh.claim()
    snapshots.save_frames(wh.build(spark), str(tmp_path))
    tables = from_parquet(spark, str(tmp_path))
    assert set(tables) == set(SCHEMAS) and len(SCHEMAS) == 24
    assert jobs.choose_extract("test", "saludmental")(tables, "20240601", "20240701").count() == 1


def test_sql_script_returns_its_last_result(spark, tmp_path):
    write(tmp_path / "q.sql", "begin\n declare x int default 2;\n select 1;\n select x + :y as z;\nend\n")
    assert jobs.run_sql_script(spark, str(tmp_path / "q.sql"), {"y": 3}).collect()[0].z == 5
    write(tmp_path / "one.sql", "select :a as a")
    assert jobs.run_sql_script(spark, str(tmp_path / "one.sql"), {"a": "v"}).collect()[0].a == "v"


def test_newest_stored_script_runs(spark, tmp_path):
    folder = tmp_path / "m/test/saludmental/queries"
    names = {"query_20240101": "select 1 as v", "query_20240301": "select :since as v, count(*) as n from persona where idpersona > 0",
             "other_20250101": "select 3 as v"}
    for name, text in names.items():
        write(folder / f"{name}.sql", text)
    write(folder / "query_2099.txt", "no script")
    assert sorted(jobs.stored_scripts(spark, str(tmp_path / "m"), "test", "saludmental")) == sorted(names)
    assert jobs.stored_scripts(spark, str(tmp_path / "m"), "test", "nothing") == {}
    wh = Micro().build(spark)

    def run(text):
        chosen = jobs.choose_extract("test", "saludmental", text, spark, str(tmp_path / "m"))
        return [tuple(r) for r in chosen(wh, "20240601", "20240701").collect()]

    assert run("query") == [("20240601", wh["persona"].count())]
    assert run("other") == [(3,)] and run("0101") == [(1,)]
    with pytest.raises(FileNotFoundError):
        run("nothing like it")
    # A version that comes with the package is one of them: it runs where no script is stored.
    found = jobs.choose_extract("test", "saludmental", "query", spark, str(tmp_path / "elsewhere"))
    assert found is jobs.choose_extract("test", "saludmental")


def test_extract_job(spark, tmp_path):
    wh = Micro()
    for i in range(4):
        wh.claim(request=f"r{i}", details=[{"cantidad": i + 1}])
    tables = wh.build(spark)
    target = jobs.extract(tables, "input", "test", "saludmental", "20240601", "20240701", str(tmp_path), "20240701_0000")
    assert snapshots.read_latest(spark, target).count() == 4
    with pytest.raises(ValueError, match="Invalid action: output"):
        jobs.extract(tables, "output", "test", "saludmental", "20240601", "20240701", str(tmp_path), "x")


def test_declared_columns_and_types(spark):
    remote = spark.sql("select '7' as IDDENUNCIO, 12 as NumeroDenuncio, 'x' as other")
    found = declared(remote, "denuncio")
    assert found.schema.simpleString() == "struct<iddenuncio:bigint,NumeroDenuncio:string>" and tuple(found.first()) == (7, "12")
    assert declared(remote, "unknown").columns == remote.columns


def test_staged_paths_can_be_removed(spark):
    before = len(session._handed_out)
    kept = session.stage(spark.range(3), "removable")
    path = session._handed_out[-1]
    assert kept.count() == 3 and len(session._handed_out) == before + 1
    others, session._handed_out[:] = session._handed_out[:-1], [path]
    try:
        assert session.remove_staged(spark) == 1 and session._handed_out == []
        with pytest.raises(Exception, match="(?i)path"):
            spark.read.parquet(path)
    finally:
        session._handed_out[:] = others
