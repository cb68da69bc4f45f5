"""Raw registry files generated from the driver tables (plus F3 dirty rows)."""

from __future__ import annotations

import os
import zipfile

from regiflow.plans import standins as S
from regiflow.schema import LAYOUTS

# Rows made to hit the reader rules (FIXTURES.md F3), in Empresas layout.
DIRTY_LINES = [
    ';SEM CHAVE;2062;05;1,00;01;',                      # null key
    '123456789;NOVE DIGITOS;2062;05;1,00;01;',           # 9-character key
    '77;\xa0NBSP E TAB\t;2062;05;-5,00;01;',            # NBSP/TAB padding, negative capital
    '78;NULL;2062;05;abc;01;',                            # NULL name, bad capital
    '79;"ASPAS ""DUPLAS""; E PONTO";2062;05;1.000,50;01;',  # doubled quotes, embedded ;
    '80;AÇÃO ÉPICA;2062;05;;01;',                         # accents, empty capital
    '81;A;B;C;D;E;F;G',                                   # one field too many
    '82;CURTA',                                           # too few fields
]


def csv_lines(spark, sf_dir: str) -> list[str]:
    raw = S.raw_companies(spark, sf_dir).collect()

    def fmt(v):
        if v is None:
            return ""
        return '"' + v.replace('"', '""') + '"' if (";" in v or '"' in v) else v
    return [";".join(fmt(r[c]) for c in LAYOUTS["Empresas"]) for r in raw]


def write_csv(path: str, lines: list[str]) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(("\n".join(lines) + "\n").encode("latin-1"))


def write_zip(path: str, members: dict[str, list[str]]) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for name, lines in members.items():
            zf.writestr(name, ("\n".join(lines) + "\n").encode("latin-1"))
