"""The three jobs: extract a snapshot, prepare it, score it."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from claimlens.operators.anomaly import score_rows
from claimlens.functions.text import quoted
from claimlens.operators.features import ROW_ID, Prepared, apply_types, lower_names, prepare
from claimlens.operators.rowid import add_row_id
from claimlens.plans.detail import detail_extract
from claimlens.plans.insured import insured_extract
from claimlens.sources import snapshots
from claimlens.sources.warehouse import Warehouse

ACTIONS = ["input"]
SCRIPT = ".sql"

# Stored queries per (model, dataset); the newest name that contains the search text runs.
EXTRACTS: Mapping[tuple[str, str], Mapping[str, Callable[..., DataFrame]]] = {
    ("test", "saludmental"): {"query_1": detail_extract},
    ("asegurado", "saludmental"): {"query_1": insured_extract},
}

# Columns of the detail extract that tell rows apart: all but the texts that follow from ids.
DETAIL_ORDER = [
    "ruttitular", "rutbeneficiario", "numerosolicitud", "fechaprestacion", "fecharecepcionliquidacion", "prevision",
    "rutprestador", "nombreprestador", "idgrupoprestacion", "idsubgrupoprestacion", "idaperturaprestacion",
    "cantidad", "valorprestacionclp", "valorreclamadoclp", "valorpagoclp",
    "valorprestacionuf", "valorpagouf", "costounitarioclp",
]


def run_sql_script(spark: SparkSession, path: str, args: Mapping[str, object] | None = None) -> DataFrame:
    """Run a stored SQL script, one statement or a BEGIN … END block, and return its last result."""
    text = spark.read.text(path, wholetext=True).first().value
    return spark.sql(text, args=dict(args or {}))


def stored_scripts(spark: SparkSession, queries: str, model: str, dataset: str) -> dict[str, str]:
    """Name (without the ending) and path of the SQL scripts stored for a model and dataset, as the file system
    lists them: ``<queries>/<model>/<dataset>/queries/*.sql``. A folder that is not there has none."""
    folder = f"{queries}/{model}/{dataset}/queries"
    return {name.removesuffix(SCRIPT): path for name, path in snapshots.listed(spark, folder).items() if name.endswith(SCRIPT)}


def stored_extract(spark: SparkSession, path: str) -> Callable[..., DataFrame]:
    """A stored script as an extract: the warehouse's tables are views of their names, the period's bounds the
    parameters ``:since`` and ``:until``."""

    def run(wh: Warehouse, since: str, until: str) -> DataFrame:
        for name in wh:
            wh[name].createOrReplaceTempView(name)
        return run_sql_script(spark, path, {"since": since, "until": until})

    return run


def choose_extract(
    model: str, dataset: str, search_text: str = "query", spark: SparkSession | None = None, queries: str | None = None
) -> Callable[..., DataFrame]:
    """The newest version, by name, among those that come with the package and, where ``queries`` names a
    folder, the scripts stored there; a stored script takes the place of a version of its own name."""
    versions = dict(EXTRACTS.get((model, dataset), {}))
    if queries is not None:
        stored = stored_scripts(spark, queries, model, dataset)
        versions |= {name: stored_extract(spark, path) for name, path in stored.items()}
    return versions[snapshots.newest(list(versions), search_text)]


def extract(
    wh: Warehouse, action: str, model: str, dataset: str, since: str, until: str, root: str, when: str,
    search_text: str = "query", spark: SparkSession | None = None, queries: str | None = None,
) -> str:
    """Run the newest extract of a model and dataset and store it as a snapshot; returns its root.

    With ``spark`` and a folder ``queries``, SQL scripts stored there are versions too."""
    if action not in ACTIONS:
        raise ValueError(f"Invalid action: {action}")
    target = f"{root}/{model}/{dataset}/dataset"
    chosen = choose_extract(model, dataset, search_text, spark, queries)
    snapshots.save_snapshot(chosen(wh, since, until), target, when)
    return target


def prepare_rows(rows: DataFrame, config: Mapping[str, dict], order: list[str] = DETAIL_ORDER) -> Prepared:
    """Lower-case names, declared types, row ids and features."""
    typed = apply_types(lower_names(rows), dict(config))
    return prepare(add_row_id(typed, order))


def prepare_snapshot(spark: SparkSession, root: str, model: str, dataset: str, config: Mapping[str, dict]) -> Prepared:
    """Prepare the newest snapshot and store the bundle under the same stamp."""
    base = f"{root}/{model}/{dataset}"
    when = snapshots.latest_snapshot(spark, f"{base}/dataset")
    prepared = prepare_rows(snapshots.read_latest(spark, f"{base}/dataset"), config)
    snapshots.save_bundle(prepared, base, when)
    return prepared


def score_snapshot(spark: SparkSession, root: str, model: str, dataset: str, threshold: float = 0.95) -> tuple[DataFrame, tuple[int, float, float]]:
    """Score the newest prepared bundle."""
    bundle = snapshots.read_bundle(spark, f"{root}/{model}/{dataset}")
    features = [c for c in bundle["dataset"].columns if c != ROW_ID]
    scored, choice = score_rows(bundle["dataset"], features, threshold)
    # Fitted and scored without the information, which is joined once, by a key of one row each.
    joined = snapshots.join_bundle({**bundle, "dataset": scored})
    return joined.select("anomalyscore", *quoted(c for c in joined.columns if c != "anomalyscore")), choice
