"""Sources and sinks: what a query writes below the shared folder it reads back."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import functions as F

import claimlens.plans
from catalog.base import SINCE, UNTIL, day_sql, query
from claimlens.operators import load
from claimlens.operators.features import INFORMATION, apply_types
from claimlens.plans import claims, jobs
from claimlens.plans.config import DETAIL_TYPES
from claimlens.plans.detail import detail_extract
from claimlens.session import scratch_path, shared_folder
from claimlens.sources import database, files, snapshots
from claimlens.sources.standin import StandIn

FIRST, SECOND = "20250106_0900", "20250203_0900"


def write_text(spark, text: str, path: str) -> str:
    """One small definition file, written by Spark so that it lands on the shared file system."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return path


@query("src1_catalog_table", "select count(*) as siniestros, count(distinct iddenuncio) as denuncios from siniestro")
def src1_catalog(spark, folder):
    """Tables reached by name through the catalog."""
    StandIn(spark, folder)["siniestro"].createOrReplaceTempView("reclamos")
    return spark.table("reclamos").agg(
        F.count(F.lit(1)).alias("siniestros"), F.countDistinct("iddenuncio").alias("denuncios")
    )


@query(
    "src2_stored_script",
    """select ClasificacionGrupo, ClasificacionSubgrupo, ClasificacionApertura, count(*) as codigos from clasif
       where ClasificacionSubgrupo = 'SALUD MENTAL' group by all""",
)
def src2(spark, folder):
    wh = StandIn(spark, folder)
    for name in [
        "detalle_prestacion", "subgrupo_apertura_prestacion", "grupo_subgrupo_prestacion", "grupo_prestacion",
        "subgrupo_prestacion", "apertura_prestacion", "patologia_asociada",
    ]:
        wh[name].createOrReplaceTempView(name)
    text = (Path(claimlens.plans.__file__).parent / "classification.sql").read_text()
    path = write_text(spark, text, scratch_path(spark, "script"))
    return jobs.run_sql_script(spark, path, {"subgrupo": "SALUD MENTAL"})


_EXTRACT_SQL = """select * replace (ValorPrestacionCLP as ValorPrestacionCLP) from regulares"""


def amounts(df):
    return df.withColumns(
        {c: F.col(c).cast("double") for c in df.columns if c.startswith("Valor")}
    )


@query("src3_extract_job", _EXTRACT_SQL)
def src3(spark, folder):
    root = scratch_path(spark, "models")
    target = jobs.extract(StandIn(spark, folder), "input", "test", "saludmental", SINCE, UNTIL, root, FIRST)
    return amounts(snapshots.read_latest(spark, target))


# Two stored versions of one extract: the older counts claims by day, the newer by holder and only of the period.
_STORED = {
    "query_20240601_0900": "select cast(FechaRecepcionLiquidacionVC as date) as grupo, count(*) as siniestros from siniestro group by all",
    "query_20240702_1730": """begin
      declare vigentes int default 1;
      select s.RutTitular as grupo, count(*) as siniestros, count(distinct d.NumeroDenuncio) as denuncios
      from siniestro s join denuncio d on d.iddenuncio = s.iddenuncio
      where s.vigente = vigentes and s.FechaRecepcionLiquidacionVC >= to_date(:since, 'yyyyMMdd')
        and s.FechaRecepcionLiquidacionVC < to_date(:until, 'yyyyMMdd')
      group by s.RutTitular;
    end""",
}


@query(
    "src3_newest_stored_script",
    f"""select s.RutTitular as grupo, count(*) as siniestros, count(distinct d.NumeroDenuncio) as denuncios
        from siniestro s join denuncio d on d.iddenuncio = s.iddenuncio
        where s.vigente = 1 and s.FechaRecepcionLiquidacionVC >= {day_sql(SINCE)} and s.FechaRecepcionLiquidacionVC < {day_sql(UNTIL)}
        group by s.RutTitular""",
)
def src3_stored(spark, folder):
    """Scripts are listed, the newest by name runs over the warehouse with the period as parameters."""
    root = scratch_path(spark, "models")
    for name, text in _STORED.items():
        snapshots.write_file(spark, f"{root}/test/denuncios/queries/{name}.sql", text)
    snapshots.write_file(spark, f"{root}/test/denuncios/queries/query_20991231_0000.txt", "select 'not a script' as grupo")
    wh = StandIn(spark, folder)
    tables = {name: wh[name] for name in ("siniestro", "denuncio")}
    target = jobs.extract(tables, "input", "test", "denuncios", SINCE, UNTIL, root, FIRST, spark=spark, queries=root)
    return snapshots.read_latest(spark, target)


def two_snapshots(spark, folder):
    """Orders of two periods as two snapshots."""
    root = scratch_path(spark, "snapshots")
    orders = StandIn(spark, folder).source("orders").select("o_orderkey", "o_orderdate")
    snapshots.save_snapshot(orders.where(F.col("o_orderdate") < F.to_timestamp_ntz(F.lit("1998-01-01"))), root, FIRST)
    snapshots.save_snapshot(orders.where(F.col("o_orderdate") >= F.to_timestamp_ntz(F.lit("1998-01-01"))), root, SECOND)
    return root


_NEWEST = "select o_orderkey, o_orderdate from orders where o_orderdate >= timestamp '1998-01-01'"


@query("src4_newest_by_name", f"select '{SECOND}' as snapshot, count(*) as filas from ({_NEWEST}) n")
def src4(spark, folder):
    root = two_snapshots(spark, folder)
    rows = snapshots.read_snapshots(spark, root)
    names = [r.snapshot for r in rows.select("snapshot").distinct().collect()]
    return rows.where(F.col("snapshot") == snapshots.newest(names, "2025")).groupBy("snapshot").agg(
        F.count(F.lit(1)).alias("filas")
    )


@query("src5_load_newest_snapshot", _NEWEST)
def src5(spark, folder):
    return snapshots.read_latest(spark, two_snapshots(spark, folder))


@query("src5_newest_snapshot_is_empty", "select o_orderkey from orders where false")
def src5_empty(spark, folder):
    root = two_snapshots(spark, folder)
    snapshots.save_snapshot(snapshots.read_latest(spark, root).limit(0), root, "20991231_0900")
    return snapshots.read_latest(spark, root).select("o_orderkey")


@query("lim3_latest_snapshot", f"select '{SECOND}' as snapshot, max(o_orderdate) as ultima from orders")
def lim3(spark, folder):
    root = two_snapshots(spark, folder)
    newest = snapshots.latest_snapshot(spark, root)
    rows = snapshots.read_snapshots(spark, root).where(F.col("snapshot") == newest)
    return rows.groupBy("snapshot").agg(F.max("o_orderdate").alias("ultima"))


@query("snk1_timestamped_snapshots", f"""select case when o_orderdate < timestamp '1998-01-01' then '{FIRST}' else '{SECOND}' end as snapshot,
                                                count(*) as filas, sum(o_orderkey)::bigint as claves from orders group by 1""")
def snk1(spark, folder):
    rows = snapshots.read_snapshots(spark, two_snapshots(spark, folder))
    return rows.groupBy("snapshot").agg(F.count(F.lit(1)).alias("filas"), F.sum("o_orderkey").alias("claves"))


@query("src6_semicolon_csv", "select p_partkey, p_name, p_size, p_retailprice from part")
def src6(spark, folder):
    path = scratch_path(spark, "csv")
    part = StandIn(spark, folder).source("part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    part.write.csv(path, sep=";", header=True)
    return files.read_delimited(spark, path, "p_partkey bigint, p_name string, p_size int, p_retailprice double")


_FILES = {"customer": ";", "part": ",", "supplier": "|", "nation": "\t"}


@query(
    "src7_delimiter_of_every_file",
    " union all ".join(f"select '{t}' as tabla, '{d if d != chr(9) else 'tab'}' as delimitador" for t, d in _FILES.items()),
)
def src7(spark, folder):
    root = scratch_path(spark, "delimited")
    source = StandIn(spark, folder).source
    for table, mark in _FILES.items():
        source(table).write.csv(f"{root}/{table}", sep=mark, header=True)
    found = files.detect_delimiters(spark, f"{root}/*")
    table = F.element_at(F.split("archivo", "/"), -2)
    name = F.when(F.col("delimitador") == "\t", "tab").otherwise(F.col("delimitador"))
    return found.select(table.alias("tabla"), name.alias("delimitador")).distinct()


_NOTES = """p_name || chr(10) || '"' || p_type || '"; ' || chr(13) || chr(10) || chr(10) || p_brand"""


def notes(spark, folder):
    """Parts with a text of four lines that holds quotes, a delimiter and an empty line."""
    part = StandIn(spark, folder).source("part")
    text = F.concat("p_name", F.lit('\n"'), "p_type", F.lit('"; \r\n\n'), "p_brand")
    return part.select("p_partkey", text.alias("nota"), "p_size")


@query("src7_records_across_lines", f"select p_partkey, replace({_NOTES}, chr(13), '') as nota, p_size from part")
def src7_records(spark, folder):
    """Quoted values with line breaks, delimiters and doubled quotes, read by many tasks per file."""
    path = scratch_path(spark, "notes")
    notes(spark, folder).write.csv(path, sep=";", header=True, escape='"')
    return files.read_records(spark, path, "p_partkey bigint, nota string, p_size int")


@query(
    "src7_delimiter_of_records_across_lines",
    "select 'comas' as tabla, ',' as delimitador union all select 'puntos', ';' union all select 'barras', '|' union all select 'sueltas', 'error'",
)
def src7_quoted(spark, folder):
    """Delimiters are counted per record, outside quotes: line breaks and delimiters inside do not matter."""
    root, rows = scratch_path(spark, "quoted"), notes(spark, folder)
    for name, mark in (("comas", ","), ("puntos", ";"), ("barras", "|")):
        rows.write.csv(f"{root}/{name}", sep=mark, header=True, escape='"')
    rows.select("nota").write.csv(f"{root}/sueltas", escape='"')
    found = files.detect_delimiters(spark, f"{root}/*")
    return found.select(F.element_at(F.split("archivo", "/"), -2).alias("tabla"), "delimitador").distinct()


@query("src8_types_from_json_config", """select o_orderkey::varchar as o_orderkey, trunc(o_totalprice)::bigint as o_totalprice,
                                                o_custkey::double as o_custkey, o_orderdate from orders""")
def src8(spark, folder):
    config = {
        "o_orderkey": {"dtype": "str"}, "o_totalprice": {"dtype": "int"},
        "o_custkey": {"dtype": "float"}, "o_orderdate": {"dtype": "datetime"},
    }
    path = write_text(spark, json.dumps(config), scratch_path(spark, "config"))
    orders = StandIn(spark, folder).source("orders")
    return apply_types(orders.select(*config), files.read_config(spark, path))


_FIELDS = ["Id;INT;int", "Monto;DECIMAL(12,1);float", "Fecha;DATETIME;datetime", "Glosa;VARCHAR(5);str",
           "UsuarioModificacion;VARCHAR(20);str", "FechaModificacion;DATETIME;datetime", "FechaCreacion;DATETIME;datetime"]


def table_folder(spark, folder):
    """Orders as the data of a table definition."""
    root = scratch_path(spark, "tables")
    orders = StandIn(spark, folder).source("orders")
    empty = F.lit(None).cast("string")
    data = orders.select(
        F.col("o_orderkey").alias("Id"), F.col("o_totalprice").alias("Monto"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("Fecha"), F.col("o_orderpriority").alias("Glosa"),
        empty.alias("UsuarioModificacion"), empty.alias("FechaModificacion"), empty.alias("FechaCreacion"),
    )
    data.write.csv(f"{root}/pedidos/data.csv", sep=";", header=True)
    write_text(spark, "\n".join(_FIELDS), f"{root}/pedidos/campos.txt")
    write_text(spark, "destino;pedidos", f"{root}/pedidos/paths.txt")
    write_text(spark, "USER;tester", f"{root}/configs.txt")
    return files.read_table_definition(spark, f"{root}/pedidos", f"{root}/configs.txt", read_data=True)


_LOADED = """select o_orderkey::integer as Id, (round_even(o_totalprice * 10, 0) / 10)::decimal(12,1)::double as Monto,
                    o_orderdate as Fecha, substring(o_orderpriority, 1, 5) as Glosa, 'tester' as UsuarioModificacion"""


def loaded(df):
    return df.select(
        "Id", F.col("Monto").cast("double").alias("Monto"), F.col("Fecha").cast("timestamp_ntz").alias("Fecha"), "Glosa",
        "UsuarioModificacion", *[F.lit(1).alias("creada") for _ in [0] if "FechaCreacion" in df.columns],
    )


@query("src9_table_definition", """select o_orderkey::double as Id, o_orderdate as Fecha, o_orderpriority as Glosa from orders""")
def src9(spark, folder):
    data = table_folder(spark, folder)["data"]
    return data.select("Id", F.col("Fecha").cast("timestamp_ntz").alias("Fecha"), "Glosa")


@query("dq2_audit_columns_on_create", f"{_LOADED}, 1 as creada from orders")
def dq2_create(spark, folder):
    table = table_folder(spark, folder)
    return loaded(load.prepare_load(table["data"], table["campos"], table["configs"], "create")[0])


@query("dq2_audit_columns_on_update", f"{_LOADED} from orders")
def dq2_update(spark, folder):
    table = table_folder(spark, folder)
    return loaded(load.prepare_load(table["data"], table["campos"], table["configs"], "update")[0])


@query(
    "dq4_database_type_map",
    f"""{_LOADED}, '{", ".join(f.split(";")[0] + " " + f.split(";")[1] for f in _FIELDS if "Creacion" not in f)}' as tipos
        from orders""",
)
def dq4(spark, folder):
    table = table_folder(spark, folder)
    data, types = load.prepare_load(table["data"], table["campos"], table["configs"], "update")
    return loaded(data).withColumn("tipos", F.lit(types))


@query(
    "snk2_prepared_bundle",
    f"select '{FIRST}' as stamp, count(*) as filas, {len(INFORMATION)} as informacion from regulares",
)
def snk2(spark, folder):
    root = scratch_path(spark, "bundle")
    jobs.extract(StandIn(spark, folder), "input", "test", "saludmental", SINCE, UNTIL, root, FIRST)
    jobs.prepare_snapshot(spark, root, "test", "saludmental", DETAIL_TYPES)
    base = f"{root}/test/saludmental"
    bundle = snapshots.read_bundle(spark, base)
    stamp = snapshots.latest_bundle(spark, base)
    roles = bundle["variables"].where("role = 'information'").agg(F.count(F.lit(1)).cast("int")).scalar()
    return snapshots.join_bundle(bundle).agg(
        F.lit(stamp).alias("stamp"), F.count(F.lit(1)).alias("filas"), F.max(roles).alias("informacion")
    )


@query(
    "snk2_newest_complete_bundle",
    f"""select '{FIRST}' as stamp, count(*) as filas, sum(p_partkey)::bigint as claves, sum(p_size)::bigint as tallas from part""",
)
def snk2_complete(spark, folder):
    """A bundle whose newer tables are not all there yet: the older one is read, all of it."""
    root, part = scratch_path(spark, "bundle"), StandIn(spark, folder).source("part")
    features = part.select(F.col("p_partkey").alias("uniqueid"), "p_size")
    for name, rows in (("dataset", features), ("information", part.selectExpr("p_partkey as uniqueid", "p_partkey")), ("variables", features)):
        snapshots.save_snapshot(rows, f"{root}/prepared/{name}", FIRST)
    snapshots.save_snapshot(features.limit(1), f"{root}/prepared/dataset", SECOND)
    return snapshots.join_bundle(snapshots.read_bundle(spark, root)).agg(
        F.lit(snapshots.latest_bundle(spark, root)).alias("stamp"),
        F.count(F.lit(1)).alias("filas"),
        F.sum("p_partkey").alias("claves"),
        F.sum("p_size").alias("tallas"),
    )


@query(
    "snk2_bundle_of_one_run",
    f"""select '{FIRST}' as stamp, count(*) as filas, sum(p_partkey)::bigint as claves, sum(p_size + 100)::bigint as tallas from part""",
)
def snk2_run(spark, folder):
    """Reruns under one stamp: the second replaces the first, whole; the third stops after its first table and
    changes nothing."""
    root, part = scratch_path(spark, "bundle"), StandIn(spark, folder).source("part")

    def tables(added):
        features = part.select(F.col("p_partkey").alias("uniqueid"), (F.col("p_size") + added).alias("p_size"))
        keys = part.selectExpr("p_partkey as uniqueid", "p_partkey")
        return {"dataset": features, "information": keys, "variables": features.limit(1)}

    snapshots.save_tables(tables(0), root, FIRST)
    snapshots.save_tables(tables(100), root, FIRST)
    stopped = tables(1000)
    stopped["information"] = stopped["information"].withColumn("uniqueid", F.raise_error(F.lit("stopped")).cast("bigint"))
    try:
        snapshots.save_tables(stopped, root, FIRST)
    except Exception as error:
        if "stopped" not in str(error):
            raise
    return snapshots.join_bundle(snapshots.read_bundle(spark, root)).agg(
        F.lit(snapshots.latest_bundle(spark, root)).alias("stamp"),
        F.count(F.lit(1)).alias("filas"),
        F.sum("p_partkey").alias("claves"),
        F.sum("p_size").alias("tallas"),
    )


@query("ml6_scored_bundle")
def ml6_bundle(spark, folder):
    root = scratch_path(spark, "model")
    jobs.extract(StandIn(spark, folder), "input", "test", "saludmental", SINCE, UNTIL, root, FIRST)
    jobs.prepare_snapshot(spark, root, "test", "saludmental", DETAIL_TYPES)
    return jobs.score_snapshot(spark, root, "test", "saludmental")[0]


@query(
    "snk3_several_named_outputs",
    """select 'sheet0' as hoja, count(*) as filas from customer union all select 'sheet1', count(*) from supplier
       union all select 'pedidos', count(*) from orders""",
)
def snk3(spark, folder):
    root = scratch_path(spark, "sheets")
    source = StandIn(spark, folder).source
    paths = snapshots.save_frames([source("customer"), source("supplier")], root)
    paths += snapshots.save_frames({"pedidos": source("orders")}, root, fmt="csv")
    counts = [
        (spark.read.option("header", True).csv(p) if p.endswith("pedidos") else spark.read.parquet(p)).agg(
            F.lit(p.rsplit("/", 1)[1]).alias("hoja"), F.count(F.lit(1)).alias("filas")
        )
        for p in paths
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def fresh_table(spark, label):
    path = scratch_path(spark, label)
    return "claimlens_" + path.rsplit("-", 1)[1], path


@query(
    "snk4_replace_and_append",
    "select p_partkey, p_size from part union all select p_partkey, p_size from part",
)
def snk4(spark, folder):
    part = StandIn(spark, folder).source("part").select("p_partkey", "p_size")
    table, path = fresh_table(spark, "table")
    database.load_table(part, "fail", table, path)
    database.load_table(part, "replace", table, path)
    database.load_table(part, "append", table, path)
    return spark.table(table)


@query("snk5_preview_of_loaded_table", "select count(*) as filas, 1 as iguales from (select * from part limit 5) p")
def snk5(spark, folder):
    part = StandIn(spark, folder).source("part").select("p_partkey", "p_size")
    table, path = fresh_table(spark, "preview")
    database.load_table(part, "fail", table, path)
    shown = database.preview(spark, table)
    known = shown.join(part, ["p_partkey", "p_size"], "left_semi").agg(F.count(F.lit(1))).scalar()
    return shown.agg(F.count(F.lit(1)).alias("filas")).withColumn("iguales", (known == F.col("filas")).cast("int"))


@query(
    "lim1_any_five_rows",
    """select count(*) as filas from (select * from lineitem limit 5) l""",
)
def lim1(spark, folder):
    return StandIn(spark, folder).source("lineitem").limit(5).agg(F.count(F.lit(1)).alias("filas"))
