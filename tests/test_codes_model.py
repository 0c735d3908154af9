"""resolve_codes against a plain-Python model of the reference semantics."""

from collections import defaultdict

from helpers import FIELDS, raw_rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata import catalogue as C
from strata.operators import resolve_codes

DICT = [("18", "Drama"), ("35", "Comedia"), ("28", "Azione"), ("28", "Action"), ("10", "Z")]
KEY = list(C.SILVER_KEY)


def _order(t):
    return tuple((x is None, "" if x is None else x) for x in t)


def model(rows):
    by_code = defaultdict(list)
    for code, name in DICT:
        by_code[code].append(name)
    parts, keys = defaultdict(list), set()
    for r in rows:
        full = {**BASE, **r}
        if full[C.CODES] is None:
            continue
        key = tuple(full[c] for c in KEY)
        keys.add(key)
        for pos, code in enumerate(full[C.CODES].split(",")):
            parts[key].extend((pos, n) for n in by_code.get(code.strip(" "), []))
    return sorted((key + (", ".join(n for _, n in sorted(parts[key])),) for key in keys), key=_order)


BASE = dict(zip(FIELDS, [None] * len(FIELDS)))
BASE.update({"pelicula_id": "1", "titulo": "t", "titulo_original": "o", "fecha_estreno": "2020-01-01",
             "anio_estreno": 2020, "popularidad": 1.0, "valoracion_media": 5.0, "num_votos": 100,
             "idioma_original": "it", "descripcion": "d", "genero_ids": "18"})

code = st.sampled_from(["18", "35", "28", "99", "", " 35", "10 ", "x"])
film = st.fixed_dictionaries({
    "pelicula_id": st.sampled_from(["1", "2", "3"]),
    "titulo": st.sampled_from(["a", "b", None]),
    "popularidad": st.sampled_from([1.0, 2.5]),
    "genero_ids": st.one_of(st.none(), st.lists(code, max_size=4).map(",".join)),
})


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(film, min_size=1, max_size=25))
def test_resolve_codes_matches_model(spark, rows):
    d = spark.createDataFrame(DICT, "genero_id string, genero_nombre string")
    got = sorted((tuple(r[c] for c in KEY + [C.NAMES])
                  for r in resolve_codes(raw_rows(spark, rows).repartition(3), d).collect()), key=_order)
    assert got == model(rows)
