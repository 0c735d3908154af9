"""Small builders for raw film rows in tests."""

from strata import schemas

FIELDS = [f.name for f in schemas.RAW_FILMS.fields]


def raw_rows(spark, rows):
    """rows: dicts with any subset of raw columns; the rest default sensibly."""
    base = {"pelicula_id": "1", "titulo": "t", "titulo_original": "o", "fecha_estreno": "2020-01-01",
            "anio_estreno": 2020, "popularidad": 1.0, "valoracion_media": 5.0, "num_votos": 100,
            "idioma_original": "it", "descripcion": "d", "genero_ids": "18"}
    data = [tuple({**base, **r}[f] for f in FIELDS) for r in rows]
    return spark.createDataFrame(data, schemas.RAW_FILMS)
