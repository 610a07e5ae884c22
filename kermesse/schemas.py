"""Column lists and types of the tables. Wall-clock times are TIMESTAMP_NTZ."""

from __future__ import annotations

CANDIDATE = (
    "seq bigint, titulo string, categoria string, descripcion_corta string, "
    "inicio timestamp_ntz, fin timestamp_ntz, todo_el_dia boolean, lugar_nombre string, "
    "lugar_direccion string, comuna string, lat double, lon double, precio_clp int, "
    "es_gratis boolean, precio_texto string, fuente_tipo string, fuente_nombre string, "
    "fuente_url string, link_entradas string, imagen_url string, id_externo string, "
    "fecha_publicacion timestamp_ntz")
STORE = (
    "hash_dedup string, titulo string, categoria string, descripcion_corta string, "
    "inicio timestamp_ntz, fin timestamp_ntz, todo_el_dia boolean, lugar_nombre string, "
    "lugar_direccion string, comuna string, lat double, lon double, precio_clp int, "
    "es_gratis boolean, precio_texto string, fuente_tipo string, fuente_nombre string, "
    "fuente_url string, link_entradas string, imagen_url string, id_externo string, "
    "fecha_extraccion timestamp_ntz, fecha_ultima_verificacion timestamp_ntz, "
    "visto_por_ultima_vez timestamp_ntz, estado string, estado_previo string")
RUN_LOG = ("momento timestamp_ntz, fuente string, encontrados int, nuevos int, "
           "actualizados int, descartados int, error string, duracion_seg double")
OFFER = (
    "banco_id string, banco string, comercio string, categoria string, cocina string, "
    "comuna string, region string, direccion string, telefono string, lat double, "
    "lon double, precision string, direccion_prestada_de string, sitio_web string, "
    "porcentaje int, oferta string, tope int, dias array<string>, vigencia_hasta date, "
    "tarjetas array<string>, modalidad string, segmentado boolean, condiciones string, "
    "url string, logo string, capturado string")
RESOLUTION = ("qid string, lugar string, direccion string, comuna string, lat double, lon double, precision string, "
              "resuelto timestamp_ntz, corrida string, dia date")
ADDRESS_CATALOGUE = "calle string, numero int, ciudad string, lat double, lon double"
PLACE_CATALOGUE = "nombre string, tipo string, lat double, lon double, direccion string, ciudad string"

STATES = ("borrador", "publicado", "descartado", "caducado", "revisar_fecha")
SOURCE_KINDS = ("wordpress", "eventon", "rss", "html", "sitemap", "carteleras", "cine", "tabla",
                "json", "manual", "ticketmaster")


def names(ddl: str) -> list[str]:
    """Column names of a DDL list; array element types hold no commas here."""
    return [part.strip().split(" ", 1)[0] for part in ddl.split(", ")]


def conform(df, ddl: str):
    """Only the known columns, in order, with their types; absent ones become NULL."""
    from pyspark.sql import functions as F
    cols = []
    for part in ddl.split(", "):
        name, kind = part.strip().split(" ", 1)
        cols.append((F.col(name) if name in df.columns else F.lit(None)).cast(kind).alias(name))
    return df.select(*cols)
