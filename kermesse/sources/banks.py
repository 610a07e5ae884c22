"""Offers of the seven issuer formats, from captured bodies to the offer table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kermesse.functions import offers as fn
from kermesse.functions.dates import iso_date
from kermesse.functions.money import cap_amount, percent_in
from kermesse.functions.places import (coord_in_country, offer_html_fields, parse_branches, place_from_tags,
                                       region_list)
from kermesse.functions.text import normalise_url, strip_html
from kermesse.operators.offers import homologate
from kermesse.operators.skew import lookup
from kermesse.schemas import OFFER, conform
from kermesse.sources.captures import nested, order_number
from kermesse.sources.json_items import items, raw_at


@dataclass(frozen=True)
class Issuer:
    """Options of one issuer."""

    id: str
    name: str
    categories: tuple[str, ...] = ()
    detail_url: str = ""
    agenda_url: str = ""


def offer_rows(rows: DataFrame) -> DataFrame:
    """The offer table plus ``seq``, homologated."""
    return homologate(conform(rows, OFFER + ", seq bigint"))


def _text(v: Column, path: str) -> Column:
    return F.coalesce(raw_at(v, path), F.lit(""))


def _strings(v: Column, path: str) -> Column:
    p = "$" + "".join(f"['{x}']" for x in path.split("."))
    return F.coalesce(F.try_variant_get(v, p, "array<string>"), F.array().cast("array<string>"))


def _issuer(rows: DataFrame, bank: Issuer) -> DataFrame:
    return rows.withColumns({"banco_id": F.lit(bank.id), "banco": F.lit(bank.name)})


def _detail(template: str, slug: Column) -> Column:
    head, _, tail = template.partition("{slug}")
    return F.concat(F.lit(head), slug, F.lit(tail))


def offers_by_branch(captures: DataFrame, bank: Issuer) -> DataFrame:
    """Entries with a branch list: one row per branch, else one row placed by its tags."""
    v = F.col("item")
    rows = items(captures, "entries")
    if bank.categories:
        rows = rows.filter(_text(v, "meta.category").isin(*bank.categories))
    f = lambda k: _text(v, f"fields.{k}")
    tags = _strings(v, "meta.tags")
    rows = rows.withColumns({
        "tags": tags, "cond": strip_html(f("Condiciones Comerciales")), "desc": strip_html(f("Descripcion")),
        "ext": f("Extracto"), "br": parse_branches(f("Sucursales")), "at": place_from_tags(tags)})
    fallback = F.array(F.struct(F.lit("").alias("address"), F.col("at.region").alias("region"), F.col("at.area").alias("area")))
    rows = rows.withColumn("br", F.when(F.size("br") > 0, F.col("br")).otherwise(fallback))
    c = F.col
    name = F.trim(F.coalesce(F.when(f("Titulo") != "", f("Titulo")), _text(v, "meta.name")))
    rubric = _text(v, "meta.category_slug")
    return offer_rows(_issuer(rows.select("*", F.posexplode("br").alias("k", "b")).select(
        order_number(c("captura"), c("pos"), c("k")).alias("seq"), name.alias("comercio"),
        F.when(rubric != "", rubric).otherwise("restaurantes").alias("categoria"),
        c("b.area").alias("comuna"), c("b.region").alias("region"), c("b.address").alias("direccion"),
        percent_in(f("Titulo"), c("desc"), c("cond")).alias("porcentaje"), fn.offer_label(c("ext"), c("cond")).alias("oferta"),
        cap_amount(c("cond")).alias("tope"), fn.weekdays_in_offer(F.array_join("tags", " "), c("ext")).alias("dias"),
        fn.expiry_in(f("Vigencia"), c("cond")).alias("vigencia_hasta"), _strings(v, "fields.Tarjetas Permitidas").alias("tarjetas"),
        fn.channel_in(c("ext"), c("cond")).alias("modalidad"),
        F.array_contains(F.transform("tags", F.lower), "segmentado").alias("segmentado"), c("cond").alias("condiciones"),
        _detail(bank.detail_url, _text(v, "meta.slug")).alias("url"), normalise_url(f("Sitio web")).alias("sitio_web"),
        F.trim(f("Telefono")).alias("telefono"), f("Logo.url").alias("logo")), bank))


def offers_from_promotions(captures: DataFrame, bank: Issuer, category: str = "") -> DataFrame:
    """Promotions whose day, address and phone live in their HTML."""
    v, c = F.col("item"), F.col
    rows = items(captures, "promotions").withColumns({
        "raw": _text(v, "description"), "desc": strip_html(_text(v, "description")),
        "cond": strip_html(_text(v, "options.conditions")), "at": place_from_tags(_strings(v, "tags")),
        "title": _text(v, "title")}).withColumn("h", offer_html_fields(c("raw")))
    number = F.when(_text(v, "discount").rlike(r"^\d+$"), _text(v, "discount").try_cast("int"))
    rubric = F.when(_text(v, "category") != "", _text(v, "category")).otherwise(F.lit(category))
    street = F.trim(_text(v, "location_street"))
    return offer_rows(_issuer(rows.select(
        order_number(c("captura"), c("pos")).alias("seq"), fn.trim_dangling_title(c("title")).alias("comercio"),
        F.element_at(F.split(rubric, "/"), -1).alias("categoria"),
        F.when(c("h.area") != "", c("h.area")).otherwise(c("at.area")).alias("comuna"), c("at.region").alias("region"),
        F.coalesce(F.when(number.between(1, 100), number), percent_in(c("title"), c("desc"), c("cond"))).alias("porcentaje"),
        fn.offer_label(c("desc"), c("cond")).alias("oferta"), cap_amount(c("cond")).alias("tope"),
        fn.weekdays_in_offer(c("desc"), c("cond")).alias("dias"), fn.expiry_in(c("cond"), c("desc")).alias("vigencia_hasta"),
        F.array().cast("array<string>").alias("tarjetas"), fn.channel_in(c("desc"), c("cond")).alias("modalidad"),
        F.lit(False).alias("segmentado"), c("cond").alias("condiciones"), _text(v, "url").alias("url"),
        F.when(street != "", street).otherwise(c("h.address")).alias("direccion"), c("h.phone").alias("telefono"),
        normalise_url(c("h.site")).alias("sitio_web"), F.coalesce(F.get(_strings(v, "covers"), F.lit(0)), F.lit("")).alias("logo"),
        coord_in_country(raw_at(v, "latitude"), "lat").alias("lat"),
        coord_in_country(raw_at(v, "longitude"), "lon").alias("lon")), bank))


def offers_with_amounts(captures: DataFrame, bank: Issuer, amounts: DataFrame) -> DataFrame:
    """Content entries joined to the amount of a second content type and to their logo asset."""
    v, c = F.col("item"), F.col
    f = lambda k: _text(v, f"fields.{k}")
    mine = _strings(v, "fields.categoriaV2")
    rows = items(captures, "items").withColumn("cats", mine)
    if bank.categories:
        rows = rows.filter(F.arrays_overlap("cats", F.array(*[F.lit(x) for x in bank.categories])))
    money = items(amounts, "items").select(_text(v, "fields.permalink").alias("permalink"),
                                           F.trim(_text(v, "fields.centerDiscountText")).alias("monto"),
                                           order_number(c("captura"), c("pos")).alias("o"))
    money = money.filter("permalink != '' and monto != ''").groupBy("permalink").agg(F.max(F.struct("o", "monto"))["monto"].alias("monto"))
    assets = items(captures, "includes.Asset").select(_text(v, "sys.id").alias("asset"), _text(v, "fields.file.url").alias("file"))
    assets = assets.filter("asset != ''").groupBy("asset").agg(F.min("file").alias("file"))
    rows = rows.withColumns({"permalink": f("permalink"), "asset": f("imageApp.sys.id"), "text": F.concat_ws(
        " · ", f("subtituloCajaV2"), f("descripcionCortaApp"), f("nombreBeneficio"))})
    rows = lookup(lookup(rows, money, ["permalink"]), assets, ["asset"])
    monto, file = F.coalesce("monto", F.lit("")), F.coalesce("file", F.lit(""))
    return offer_rows(_issuer(rows.select(
        order_number(c("captura"), c("pos")).alias("seq"),
        F.trim(F.when(f("empresaBeneficioV2") != "", f("empresaBeneficioV2")).otherwise(f("nombreBeneficio"))).alias("comercio"),
        F.when(F.array_contains("cats", "Restaurantes"), "restaurantes").otherwise("antojos").alias("categoria"),
        F.lit("").alias("comuna"), region_list(_strings(v, "fields.region")).alias("region"), F.lit("").alias("direccion"),
        percent_in(monto, f("nombreBeneficio"), c("text")).alias("porcentaje"),
        F.when((monto != "") & ~F.contains(monto, F.lit("%")), monto).otherwise(fn.offer_label(c("text"))).alias("oferta"),
        cap_amount(c("text")).alias("tope"), fn.weekdays_in_offer(F.array_join(_strings(v, "fields.diasDescuento"), " ")).alias("dias"),
        iso_date(raw_at(v, "fields.fechaTerminoV2")).alias("vigencia_hasta"),
        F.transform(_strings(v, "fields.paymentMethodBenefit"), F.lower).alias("tarjetas"),
        fn.channel_in(c("text")).alias("modalidad"), F.lit(False).alias("segmentado"),
        F.regexp_replace("text", "^[ ·]+|[ ·]+$", "").alias("condiciones"), normalise_url(f("urlV2")).alias("sitio_web"),
        _detail(bank.detail_url, c("permalink")).alias("url"),
        F.when(file.startswith("//"), F.concat(F.lit("https:"), file)).otherwise(file).alias("logo")), bank))


def offers_manual_capture(captures: DataFrame, bank: Issuer) -> DataFrame:
    """Hand-captured rows; the capture date travels with each one."""
    v, c = F.col("item"), F.col
    head = captures.select(F.col("seq").alias("captura"), F.try_parse_json("body").alias("doc"))
    rows = items(captures, "descuentos").join(head.select(
        "captura", F.try_variant_get("doc", "$.capturado", "string").alias("cap"),
        F.try_variant_get("doc", "$.fuente", "string").alias("fue")), "captura")
    t = lambda k: F.trim(_text(v, k))
    rows = rows.withColumn("comercio", t("comercio")).filter("comercio != ''")
    regions = F.filter(F.transform(F.split(t("region"), ","), lambda x: F.trim(x)), lambda r: r != "")
    cond = F.when(t("condiciones") != "", t("condiciones")).otherwise(t("cuando"))
    return offer_rows(_issuer(rows.select(
        order_number(c("captura"), c("pos")).alias("seq"), "comercio", t("categoria").alias("categoria"),
        t("direccion").alias("direccion"), t("comuna").alias("comuna"), t("sitio_web").alias("sitio_web"),
        F.when(F.size(regions) <= 3, F.array_join(regions, " · ")).otherwise("Todo Chile").alias("region"), t("logo").alias("logo"),
        percent_in(t("monto")).alias("porcentaje"), F.lit("").alias("oferta"),
        F.when(t("tope").rlike(r"^\d+$"), t("tope").try_cast("int")).otherwise(cap_amount(cond)).alias("tope"),
        fn.expiry_in(t("vigencia"), t("condiciones")).alias("vigencia_hasta"), fn.weekdays_in_offer(t("cuando")).alias("dias"),
        fn.channel_in(t("cuando")).alias("modalidad"),
        F.when(t("tarjeta") != "", F.array(F.lower(t("tarjeta")))).otherwise(F.array().cast("array<string>")).alias("tarjetas"),
        (t("tarjeta") != "").alias("segmentado"), cond.alias("condiciones"), F.coalesce("fue", F.lit("")).alias("url"),
        F.coalesce("cap", F.lit("")).alias("capturado")), bank))


def offers_embedded_array(captures: DataFrame, bank: Issuer, card: str = "") -> DataFrame:
    """A JSON array inside a script of the page; inactive rows and rows with neither day nor amount drop."""
    v, c = F.col("item"), F.col
    array = F.regexp_extract("body", r"(?s)window\.CardsAPI\s*=\s*\{.*?return\s*(\[.*?\]);", 1)
    rows = items(captures.withColumn("body", array))
    cats = F.transform(_strings(v, "categories"), F.lower)
    keep = F.coalesce(F.try_variant_get(v, "$.is_active", "boolean"), F.lit(True))
    if bank.categories:
        keep &= F.arrays_overlap(cats, F.array(*[F.lit(x.lower()) for x in bank.categories]))
    rows = rows.filter(keep).withColumns({"t": F.trim(_text(v, "title")), "s": _text(v, "short_description"),
                                          "l": strip_html(_text(v, "legal_text"))})
    rows = rows.withColumn("dias", fn.weekdays_in_offer(c("t"), c("s")))
    rows = rows.filter((F.size("dias") > 0) | percent_in(c("t")).isNotNull())
    short = F.trim("s")
    return offer_rows(_issuer(rows.select(
        order_number(c("captura"), c("pos")).alias("seq"), fn.merchant_from_title(c("t")).alias("comercio"),
        F.lit("restaurantes").alias("categoria"), F.lit("").alias("comuna"), F.lit("Todo Chile").alias("region"),
        F.lit("").alias("direccion"), percent_in(c("t"), c("s")).alias("porcentaje"), fn.offer_label(c("t"), c("s")).alias("oferta"),
        "dias", fn.expiry_in(c("l")).alias("vigencia_hasta"), F.array(F.lit(card or bank.id)).alias("tarjetas"),
        fn.channel_in(c("t"), c("s")).alias("modalidad"), F.lit(False).alias("segmentado"),
        F.when(short != "", short).otherwise(F.col("l")).alias("condiciones"),
        F.when(_text(v, "url") != "", _text(v, "url")).otherwise(F.lit(bank.agenda_url)).alias("url")), bank))


# Shape of a benefit card inside the page script.
CARD_SHAPE = (r'(?s)"href":"(https://[^"]+/beneficios/descuentos/[a-z0-9-]+)".*?"title":"([^"]*)","text":"([^"]*)"'
              r'.*?"section": "([^"]*)"')


def offers_embedded_cards(captures: DataFrame, bank: Issuer, card: str = "") -> DataFrame:
    """Loose benefit cards of a page, the first per address."""
    c = F.col
    found = captures.select(F.col("seq").alias("captura"), F.posexplode(F.regexp_extract_all(
        "body", F.lit(CARD_SHAPE), 0)).alias("pos", "card"))
    part = lambda i: F.regexp_extract("card", CARD_SHAPE, i)
    clean = lambda x: F.replace(F.replace(x, F.lit("**"), F.lit("")), F.lit("&#39;"), F.lit("'"))
    rows = found.select(order_number(c("captura"), c("pos")).alias("seq"), part(1).alias("url"),
                        F.trim(F.replace(part(2), F.lit("&#39;"), F.lit("'"))).alias("comercio"),
                        clean(part(3)).alias("x"), F.lower(part(4)).alias("sec")).filter("comercio != ''")
    if bank.categories:
        rows = rows.filter(c("sec").isin(*[x.lower() for x in bank.categories]))
    first = rows.groupBy("url").agg(F.min(F.struct("seq", "comercio", "x")).alias("r")).select("url", "r.*")
    return offer_rows(_issuer(first.select(
        "seq", "comercio", F.lit("restaurantes").alias("categoria"), F.lit("").alias("comuna"), F.lit("Todo Chile").alias("region"),
        F.lit("").alias("direccion"), percent_in(c("x")).alias("porcentaje"), fn.offer_label(c("x")).alias("oferta"),
        fn.weekdays_in_offer(c("x")).alias("dias"), F.array(F.lit(card or bank.id)).alias("tarjetas"),
        fn.channel_in(c("x")).alias("modalidad"), F.lit(False).alias("segmentado"), F.col("x").alias("condiciones"),
        "url"), bank))


def _value(v: Column, path: str) -> Column:
    """A field wrapped as ``{"value": ...}`` or given bare."""
    wrapped = F.try_variant_get(v, "$" + "".join(f"['{p}']" for p in f"{path}.value".split(".")), "string")
    return F.trim(F.coalesce(wrapped, raw_at(v, path), F.lit("")))


def _wrapped_list(v: Column, path: str) -> Column:
    """Texts of ``{"array": [{"txtItem": {"value": ...}}]}`` unless the block is inactive."""
    p = "$" + "".join(f"['{x}']" for x in path.split("."))
    active = F.coalesce(F.try_variant_get(v, p + ".config.active", "boolean"), F.lit(True))
    rows = F.coalesce(F.try_variant_get(v, p + ".array", "array<variant>"), F.array().cast("array<variant>"))
    texts = F.filter(F.transform(rows, lambda r: _value(r, "txtItem")), lambda t: (t != "") & (t != "."))
    return F.when(active, texts).otherwise(F.array().cast("array<string>"))


def offers_nested_active(captures: DataFrame, bank: Issuer, card: str = "") -> DataFrame:
    """Boxes of items with an active switch at each level; the day comes only from the validity field."""
    v, c = F.col("item"), F.col
    on = lambda x: F.coalesce(F.try_variant_get(x, "$.config.active", "boolean"), F.lit(True))
    boxes = items(captures, "data").filter(on(v))
    inner = boxes.select("captura", c("pos").alias("box"), F.posexplode(F.try_variant_get(v, "$.items", "array<variant>")
                                                                       ).alias("pos", "item")).filter(on(c("item")))
    p = lambda k: _value(v, f"params.{k}")
    rows = inner.withColumn("comercio", p("txtNameComercio")).filter("comercio != ''").withColumns({
        "where": p("txtDetalleCard"), "legal": p("details.txtLegal"), "dir": _wrapped_list(v, "params.details.arrDireccion"),
        "vig": _wrapped_list(v, "params.details.arrVigencia"), "hor": _wrapped_list(v, "params.details.arrHorarios")})
    areas = F.transform(F.split(F.regexp_extract("where", r"\(([^)]*)\)", 1), "/"), lambda x: F.trim(x))
    return offer_rows(_issuer(rows.select(
        order_number(c("captura"), nested(c("box"), c("pos"))).alias("seq"), "comercio", F.lit("restaurantes").alias("categoria"),
        p("txtSubtitulo").alias("cocina"), F.when(F.size(areas) == 1, F.get(areas, F.lit(0))).otherwise("").alias("comuna"),
        F.when(F.contains("where", F.lit("R.M.")), "Metropolitana de Santiago").otherwise("").alias("region"),
        F.coalesce(F.get("dir", F.lit(0)), F.lit("")).alias("direccion"), normalise_url(p("linkComercio")).alias("sitio_web"),
        percent_in(p("txtDescuento")).alias("porcentaje"), fn.offer_label(p("txtDescuento")).alias("oferta"),
        cap_amount(c("legal")).alias("tope"), fn.weekdays_in_offer(p("txtValidezBeneficio")).alias("dias"),
        fn.expiry_in(p("txtVigenciaDetalle"), F.array_join("vig", " · "), c("legal")).alias("vigencia_hasta"),
        F.array(F.lit(card or bank.id)).alias("tarjetas"), fn.channel_in(c("legal"), c("where")).alias("modalidad"),
        F.lit(False).alias("segmentado"), F.array_join(F.concat("vig", "hor"), " · ").alias("condiciones"),
        F.lit(bank.agenda_url).alias("url"), p("imgLogo").alias("logo")), bank))
