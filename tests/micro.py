"""A hand-made warehouse: one claim that passes every rule, and variants that break one rule each."""

from datetime import date, datetime
from decimal import Decimal

from claimlens.sources.warehouse import SCHEMAS

CLAIM = {
    "RutTitular": "100", "RutSiniestrado": "100", "IdTitular": 1, "IdSiniestrado": 1,
    "FechaRecepcionLiquidacionVC": datetime(2024, 6, 10, 9, 30), "FechaSiniestro": datetime(2024, 6, 5), "vigente": 1,
    "IdPlanBeneficio": "SAL01", "IdCanal": 1, "IdDenuncioClasificacion": 1, "IdDenuncioTipo": 1,
    "IdPrevisionAsegurado": 1, "idcausaprimaria": 7,
}
DETAIL = {
    "IdLiquidacionDetalleEstado": 1, "CodigoBeneficio": "501", "IdGrupo": 100, "FechaBeneficio": datetime(2024, 6, 4),
    "cantidad": 2, "MontoValorBeneficio": Decimal("10"), "MontoAporteInstitucionSalud": Decimal("1"),
    "MontoReclamado": Decimal("9"), "MontoLiquidado": Decimal("8"), "MontoDeduciblePrestacion": Decimal("3"),
    "MontoConversionBeneficio": Decimal("0.5"), "MontoConversionReclamado": Decimal("0.4"),
    "MontoConversionLiquidado": Decimal("0.3"),
}

DIMENSIONS = {
    "detalle_prestacion": [
        ("0501", "Consulta", 11, 21, 1, 1),
        ("502", "Terapia", 11, 21, 1, 1),
        ("503", "Vencida", 11, 21, 1, 0),
        ("504", "Puente distinto", 11, 22, 1, 1),
        ("505", "Otro subgrupo", 12, 22, 1, 1),
        ("", "En blanco", 11, 21, 1, 1),
        ("A1", "No numerica", 11, 21, 1, 1),
    ],
    "subgrupo_apertura_prestacion": [(11, 1, 5, 1), (12, 2, 5, 1)],
    "grupo_subgrupo_prestacion": [(21, 3, 1, 1), (22, 3, 2, 1)],
    "grupo_prestacion": [(3, "AMBULATORIO", 1)],
    "subgrupo_prestacion": [(1, "SALUD MENTAL", 1), (2, "OTROS", 1)],
    "apertura_prestacion": [(5, "Psiquiatria", 1)],
    "patologia_asociada": [(1, 1)],
    "categorizacioncanal": [
        (1, 1, 1, 1, "Bonificacion I-Med"),
        (5, 3, 1, 1, "Dental"),
        (1, 9, 1, 1, "Canal fuera"),
        (1, 1, 1, 4, "Tipo fuera"),
        (12, 4, 1, 1, "Hospital"),
    ],
    "prestadorsucursal": [(900, 90), (901, 91), (902, 92)],
    "prestador": [(90, "7", "UNO"), (91, "Sin rut prestador", "DOS"), (92, "123456789-K", "TRES")],
    "isapre": [(1, 1, "FONASA"), (2, 1, "OTRA"), (3, 0, "VENCIDA")],
    "persona": [(1, "F", date(2000, 1, 1)), (2, None, date(1990, 1, 1))],
    "instancia_general": [(100, "HOSPITAL"), (200, "BENEFICIOS DE SALUD MENTAL"), (300, "FUERA"), (400, "OTROS BENEFICIOS")],
    "diagnostico": [(7, "F32", "DEPRESION"), (8, "Z10", "CONTROL"), (9, "F40", "ANSIEDAD"), (10, "BBB", "NADA")],
    "modelo_analitico": [(1, 1, "SALUD", "Modelo", 1), (2, 1, "SALUD", "Vencido", 0)],
    "modelo_generico": [(1, "Generico", "NS", 1)],
    "estadistico": [(1, 1, "Detalle", date(2024, 1, 1), 1), (2, 2, "Otro", date(2024, 1, 1), 1)],
    "criterio_outlier_liquidacion": [],
}


class Micro:
    """Collects claims and turns everything into DataFrames."""

    def __init__(self):
        self.tables = {name: [] for name in SCHEMAS} | {k: list(v) for k, v in DIMENSIONS.items()}
        self.next = 0

    def claim(self, details=({},), settlements=1, branch=900, request=None, rejections=0, **changes):
        """One claim with a document of the given details; returns its id."""
        self.next += 1
        key = self.next
        row = {"idsiniestro": key, "iddenuncio": key, **CLAIM, **changes}
        self.tables["siniestro"].append(row)
        self.tables["denuncio"].append({"iddenuncio": key, "NumeroDenuncio": request or f"R{key}"})
        self.tables["siniestrodocumento"].append(
            {"idsiniestro": key, "idSiniestroDocumento": key * 10, "idprestadorsucursal": branch}
        )
        for n, detail in enumerate(details):
            detail_id = key * 100 + n
            self.tables["liquidaciondetalle"].append(
                {"idliquidaciondetalle": detail_id, "idSiniestroDocumento": key * 10, **DETAIL, **detail}
            )
            self.tables["liquidaciondetallerechazo"] += [{"idliquidaciondetalle": detail_id}] * rejections
        self.tables["liquidacion"] += [{"idSiniestro": key}] * settlements
        return key

    def criterion(self, high_quantity, low_cost, high_cost, statistic=1, keys=(3, 1, 5)):
        self.tables["criterio_outlier_liquidacion"].append(
            (statistic, *keys, Decimal(high_quantity), Decimal(low_cost), Decimal(high_cost), 1)
        )

    def build(self, spark):
        out = {}
        for name, schema in SCHEMAS.items():
            columns = [part.split()[0] for part in schema.split(", ")]
            data = [tuple(row.get(c) for c in columns) if isinstance(row, dict) else row for row in self.tables[name]]
            out[name] = spark.createDataFrame(data, schema)
        return out
