"""The seven issuer formats written from parts, then read back as offers; and the offers run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kermesse.bindings import inputs as i
from kermesse.bindings.extraction import pages
from kermesse.bindings.joins import catalogue
from kermesse.bindings.registry import register, table
from kermesse.bindings.scalars import MONTHS, WD, pick
from kermesse.plans import discounts
from kermesse.sources import banks
from kermesse.sources.banks import Issuer
from kermesse.vocab import calendar as cal


def parts(spark, sf):
    return table(spark, sf, "part")


def text(c) -> Column:
    return F.col(c).cast("string")


def _pages(spark, sf, item, body):
    return pages(parts(spark, sf), item, "json", body, "p_partkey")


def _day() -> Column:
    return pick(cal.WEEKDAY_DISPLAY, F.col("p_size") % 7)


DAY = f"{WD}[p_size % 7 + 1]"
PCT = "CASE WHEN p_size >= 5 THEN p_size END"
UNTIL = "make_date(2026, 1 + p_partkey % 12, 1 + p_size % 28)"


def _until() -> Column:
    return F.concat(F.lit("Hasta el "), (F.col("p_size") % 28 + 1).cast("string"), F.lit(" de "), pick(MONTHS, F.col("p_partkey") % 12), F.lit(" de 2026"))


def iso(c):
    return F.date_format(c, "yyyy-MM-dd")


@register("a24_offers_branch_explode", f"""SELECT concat(p_name, ' ', p_partkey) AS comercio, comuna, direccion, {PCT} AS pct, {DAY} AS dias, strftime({UNTIL}, '%Y-%m-%d') AS hasta, CAST(p_size * 1000 AS int) AS tope FROM (
  SELECT *, 'Ñuñoa' AS comuna, concat('Irarrázaval ', p_size) AS direccion FROM part WHERE p_partkey % 3 = 0 UNION ALL SELECT *, 'Macul', 'Macul 2' FROM part WHERE p_partkey % 3 = 0
  UNION ALL SELECT *, 'Providencia', '' FROM part WHERE p_partkey % 3 = 1)""")
def a24(spark, sf):
    branch = F.concat(F.lit("<ul><li>a;Irarrázaval "), text("p_size"), F.lit(";RM;ÑUÑOA;x</li><li>a;Macul 2;RM;MACUL;x</li></ul>"))
    fields = F.struct(F.concat_ws(" ", "p_name", text("p_partkey")).alias("Titulo"), F.concat(F.lit("<p>"), text("p_size"), F.lit("% de descuento, tope por mesa $"), F.translate(F.format_number(F.col("p_size") * 1000, 0), ",", "."), F.lit("</p>")).alias("Condiciones Comerciales"),
                      _until().alias("Vigencia"), F.when(F.col("p_partkey") % 3 == 0, branch).otherwise("").alias("Sucursales"), F.lit("presencial").alias("Extracto"))
    meta = F.struct(F.when(F.col("p_partkey") % 3 == 2, "viajes").otherwise("sabores").alias("category"), F.array(F.lit("metropolitana de santiago"), F.lit("providencia"), _day()).alias("tags"), F.lit("s").alias("slug"))
    c = _pages(spark, sf, F.struct(meta.alias("meta"), fields.alias("fields")), lambda xs: F.to_json(F.struct(xs.alias("entries"))))
    got = banks.offers_by_branch(c, Issuer("uno", "Banco Uno", ("sabores",), "https://b.cl/{slug}"))
    return got.select("comercio", "comuna", "direccion", F.col("porcentaje").alias("pct"), F.array_join("dias", ",").alias("dias"), iso("vigencia_hasta").alias("hasta"), "tope")


@register("a25_offers_from_promos", f"""SELECT concat(p_name, ' ', p_partkey) AS comercio, CASE WHEN p_partkey % 2 = 0 THEN 'Las Condes' ELSE 'Providencia' END AS comuna, CASE WHEN p_partkey % 3 = 0 THEN 'Propia 1' ELSE 'Callao 3123' END AS direccion,
  CASE WHEN p_partkey % 5 = 0 THEN 30 ELSE p_size END AS pct, {DAY} AS dias, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE -33.4e0 END AS lat FROM part""")
def a25(spark, sf):
    html = F.concat(F.lit("<p>30% los "), _day(), F.lit('</p><ul><li class="direccion"><i></i>Callao 3123<br>'), F.when(F.col("p_partkey") % 2 == 0, "Las Condes").otherwise("Otra"), F.lit("</li></ul>"))
    item = F.struct(F.concat_ws(" ", "p_name", F.concat(text("p_partkey"), F.lit(" - Hasta un"))).alias("title"), html.alias("description"), F.array(F.lit("providencia")).alias("tags"),
                    F.when(F.col("p_partkey") % 5 == 0, "x").otherwise(text("p_size")).alias("discount"), F.when(F.col("p_partkey") % 3 == 0, "Propia 1").otherwise("").alias("location_street"),
                    F.lit("-33.4").alias("latitude"), F.when(F.col("p_partkey") % 7 == 0, "0").otherwise("-70.6").alias("longitude"))
    c = _pages(spark, sf, item, lambda xs: F.to_json(F.struct(xs.alias("promotions"))))
    got = banks.offers_from_promotions(c, Issuer("dos", "Banco Dos"), "restaurantes")
    return got.select("comercio", "comuna", "direccion", F.col("porcentaje").alias("pct"), F.array_join("dias", ",").alias("dias"), "lat")


@register("a26_offers_with_amount_join", f"""SELECT concat('Local ', p_partkey) AS comercio, CASE p_partkey % 3 WHEN 0 THEN CASE WHEN p_size BETWEEN 5 AND 90 THEN p_size END END AS pct, CASE p_partkey % 3 WHEN 1 THEN '12 cuotas' ELSE '' END AS oferta, {DAY} AS dias, 'https://img/x.png' AS logo,
  CASE WHEN p_partkey % 2 = 0 THEN 'Todo Chile' ELSE 'Metropolitana · Ñuble' END AS region, strftime({UNTIL}, '%Y-%m-%d') AS hasta FROM part WHERE p_partkey % 4 <> 0""")
def a26(spark, sf):
    k, key = F.col("p_partkey") % 3, F.concat(F.lit("b-"), text("p_partkey"))
    fields = F.struct(key.alias("permalink"), F.concat(F.lit("Local "), text("p_partkey")).alias("empresaBeneficioV2"), F.when(F.col("p_partkey") % 4 == 0, F.array(F.lit("Viajes"))).otherwise(F.array(F.lit("Restaurantes"))).alias("categoriaV2"),
                      F.when(F.col("p_partkey") % 2 == 0, F.array(*[F.lit(x) for x in "abcd"])).otherwise(F.array(F.lit("Región Metropolitana de Santiago"), F.lit("Región de Ñuble"))).alias("region"),
                      F.array(_day()).alias("diasDescuento"), F.concat(F.lit("2026-"), F.lpad((F.col("p_partkey") % 12 + 1).cast("string"), 2, "0"), F.lit("-"), F.lpad((F.col("p_size") % 28 + 1).cast("string"), 2, "0"), F.lit("T23:59:00Z")).alias("fechaTerminoV2"),
                      F.struct(F.struct(F.lit("img1").alias("id")).alias("sys")).alias("imageApp"))
    asset = F.array(F.struct(F.struct(F.lit("img1").alias("id")).alias("sys"), F.struct(F.struct(F.lit("//img/x.png").alias("url")).alias("file")).alias("fields")))
    c = _pages(spark, sf, F.struct(fields.alias("fields")), lambda xs: F.to_json(F.struct(xs.alias("items"), F.struct(asset.alias("Asset")).alias("includes"))))
    money = F.struct(F.struct(key.alias("permalink"), F.when(k == 0, F.concat(text("p_size"), F.lit("%"))).when(k == 1, "12 cuotas").alias("centerDiscountText")).alias("fields"))
    amounts = _pages(spark, sf, money, lambda xs: F.to_json(F.struct(xs.alias("items"))))
    got = banks.offers_with_amounts(c, Issuer("tres", "Banco Tres", ("Restaurantes", "Antojos"), "https://b.cl/{slug}/"), amounts)
    return got.select("comercio", F.col("porcentaje").alias("pct"), "oferta", F.array_join("dias", ",").alias("dias"), "logo", "region", iso("vigencia_hasta").alias("hasta"))


@register("a27_offers_manual_capture", f"""SELECT concat(p_name, ' ', p_partkey) AS comercio, CASE WHEN p_partkey % 2 = 0 THEN 'Todo Chile' ELSE 'RM · Maule' END AS region, p_partkey % 3 = 0 AS segmentado, {PCT} AS pct, {DAY} AS dias, '2026-08-01' AS capturado FROM part""")
def a27(spark, sf):
    item = F.struct(F.concat_ws(" ", "p_name", text("p_partkey")).alias("comercio"), F.when(F.col("p_partkey") % 2 == 0, "a, b, c, d").otherwise("RM, Maule").alias("region"), F.when(F.col("p_partkey") % 3 == 0, "Black").otherwise("").alias("tarjeta"),
                    F.concat(text("p_size"), F.lit("%")).alias("monto"), F.concat(F.lit("Todos los "), _day()).alias("cuando"))
    c = _pages(spark, sf, item, lambda xs: F.to_json(F.struct(F.lit("2026-08-01").alias("capturado"), F.lit("https://b.cl").alias("fuente"), xs.alias("descuentos"))))
    got = banks.offers_manual_capture(c, Issuer("cuatro", "Banco Cuatro"))
    return got.select("comercio", "region", "segmentado", F.col("porcentaje").alias("pct"), F.array_join("dias", ",").alias("dias"), "capturado")


@register("a28_offers_embedded_array", f"""SELECT concat(p_name, ' ', p_partkey) AS comercio, {PCT} AS pct, CASE WHEN p_partkey % 2 = 0 THEN {DAY} ELSE '' END AS dias FROM part WHERE p_partkey % 5 <> 0 AND p_partkey % 7 <> 0 AND (p_partkey % 2 = 0 OR p_size >= 5)""")
def a28(spark, sf):
    item = F.struct(F.concat(text("p_size"), F.lit("% dcto. en "), F.col("p_name"), F.lit(" "), text("p_partkey"), F.lit(".")).alias("title"), F.when(F.col("p_partkey") % 2 == 0, _day()).otherwise("siempre").alias("short_description"),
                    (F.col("p_partkey") % 5 != 0).alias("is_active"), F.array(F.when(F.col("p_partkey") % 7 == 0, "cine").otherwise("Comida")).alias("categories"))
    body = lambda xs: F.concat(F.lit("<script>window.CardsAPI = { get: function(){ return "), F.to_json(xs), F.lit("; } }</script>"))
    got = banks.offers_embedded_array(_pages(spark, sf, item, body), Issuer("cinco", "Banco Cinco", ("comida",)))
    return got.select("comercio", F.col("porcentaje").alias("pct"), F.array_join("dias", ",").alias("dias"))


@register("a28_offers_embedded_cards", f"""SELECT concat(p_name, '''s') AS comercio, {PCT} AS pct, {DAY} AS dias, concat('https://t.cl/beneficios/descuentos/p-', p_partkey) AS url FROM part WHERE p_partkey % 3 <> 0""")
def a28b(spark, sf):
    item = F.concat(F.lit('{"href":"https://t.cl/beneficios/descuentos/p-'), text("p_partkey"), F.lit('","x":1,"title":"'), F.col("p_name"), F.lit('&#39;s","text":"**'), text("p_size"), F.lit("% dcto** los días "), _day(),
                    F.lit('","k":2,"section": "'), F.when(F.col("p_partkey") % 3 == 0, "viajes").otherwise("Comida"), F.lit('"}'))
    body = lambda xs: F.concat(F.lit("<html>"), F.array_join(xs, "\n"), F.array_join(xs, "\n"), F.lit("</html>"))
    got = banks.offers_embedded_cards(_pages(spark, sf, item, body), Issuer("siete", "Club Siete", ("comida",)))
    return got.select("comercio", F.col("porcentaje").alias("pct"), F.array_join("dias", ",").alias("dias"), "url")


@register("a29_offers_nested_active", f"""SELECT concat('Local ', p_partkey) AS comercio, CASE WHEN p_partkey % 2 = 0 THEN 'Ñuñoa' ELSE '' END AS comuna, concat('Dir ', p_size) AS direccion, {PCT} AS pct, {DAY} AS dias, strftime({UNTIL}, '%Y-%m-%d') AS hasta FROM part WHERE p_partkey % 5 <> 0 AND p_partkey // 50 % 3 <> 0""")
def a29(spark, sf):
    val = lambda c: F.struct(c.alias("value"))
    block = lambda c, on: F.struct(F.struct(F.lit(on).alias("active")).alias("config"), F.array(F.struct(val(F.lit(".")).alias("txtItem")), F.struct(val(c).alias("txtItem"))).alias("array"))
    params = F.struct(val(F.concat(F.lit("Local "), text("p_partkey"))).alias("txtNameComercio"), val(F.concat(text("p_size"), F.lit("% dcto"))).alias("txtDescuento"), val(F.concat(F.lit("Todos los "), _day())).alias("txtValidezBeneficio"),
                      val(F.when(F.col("p_partkey") % 2 == 0, "R.M. (Ñuñoa)").otherwise("R.M. (Ñuñoa / Macul)")).alias("txtDetalleCard"),
                      F.struct(block(F.concat(F.lit("Dir "), text("p_size")), True).alias("arrDireccion"), block(_until(), True).alias("arrVigencia"), block(F.lit("lunes 9:00"), False).alias("arrHorarios")).alias("details"))
    item = F.struct(F.struct((F.col("p_partkey") % 5 != 0).alias("active")).alias("config"), params.alias("params"))
    c = _pages(spark, sf, item, lambda xs: F.to_json(F.struct(F.array(F.struct(F.struct((F.col("seq") % 3 != 0).alias("active")).alias("config"), xs.alias("items"))).alias("data"))))
    got = banks.offers_nested_active(c, Issuer("seis", "Banco Seis"))
    return got.select("comercio", "comuna", "direccion", F.col("porcentaje").alias("pct"), F.array_join("dias", ",").alias("dias"), iso("vigencia_hasta").alias("hasta"))


@register("p02_discounts_run", f"""WITH {i.OFFERS}, k AS (SELECT *, substr(sha1(concat(banco_id, '|', lower(trim(comercio)), '|', lower(comuna))), 1, 12) AS id,
  (len(dias) > 0)::int * 4 + (porcentaje IS NOT NULL)::int * 2 + (oferta <> '')::int + (vigencia_hasta IS NOT NULL)::int AS r FROM offers
  WHERE (vigencia_hasta IS NULL OR vigencia_hasta >= DATE '{i.OFFER_AS_OF}') AND CASE WHEN comuna <> '' THEN comuna <> 'Talca' ELSE region IN ('', 'Metropolitana') END),
o AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY id ORDER BY r DESC, seq) = 1),
d AS (SELECT comercio, first(comuna ORDER BY seq) AS dc, first(lat ORDER BY seq) AS dl FROM o WHERE direccion <> '' AND comuna <> '' GROUP BY comercio)
SELECT id, CASE WHEN direccion = '' THEN coalesce(dc, comuna) ELSE comuna END AS comuna, CASE WHEN lat IS NOT NULL OR direccion = '' AND dl IS NOT NULL THEN 'fuente' WHEN CASE WHEN direccion = '' THEN coalesce(dc, comuna) ELSE comuna END <> '' THEN 'comuna' ELSE 'sin_ubicar' END AS precision
FROM o LEFT JOIN d USING (comercio)""")
def p02(spark, sf):
    chosen = discounts.collect(i.offers(spark, sf), F.lit(i.OFFER_AS_OF))
    return discounts.locate(chosen.withColumn("precision", F.lit("")), catalogue(spark, sf)).select("id", "comuna", "precision")
