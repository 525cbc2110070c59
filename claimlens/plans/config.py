"""Declared types of the detail extract's columns."""

from __future__ import annotations

# The type contract between the extract and the preparation, in the extract's order.
DETAIL_TYPES = {
    column: {"dtype": kind}
    for column, kind in {
        "ruttitular": "str",
        "rutbeneficiario": "str",
        "numerosolicitud": "str",
        "idgrupoprestacion": "int",
        "clasificaciongrupo": "str",
        "idsubgrupoprestacion": "int",
        "clasificacionsubgrupo": "str",
        "idaperturaprestacion": "int",
        "clasificacionapertura": "str",
        "cantidad": "int",
        "valorprestacionclp": "int",
        "valorprestacionuf": "float",
        "costounitarioclp": "int",
        "valorreclamadoclp": "int",
        "valorpagouf": "float",
        "valorpagoclp": "int",
        "fechaprestacion": "datetime",
        "fecharecepcionliquidacion": "datetime",
        "prevision": "str",
        "rutprestador": "str",
        "nombreprestador": "str",
    }.items()
}
