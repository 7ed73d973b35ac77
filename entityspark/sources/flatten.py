"""Nested source payloads to flat listing rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityspark.functions import text as X
from entityspark.functions.scoring import OSM_EXCLUDED_SHOPS

SEARCH = ("struct<searchParameters:map<string,string>,knowledgeGraph:struct<title:string,website:string,descriptionLink:string,description:string,attributes:map<string,string>>,"
          "organic:array<struct<title:string,link:string,snippet:string,position:int>>,peopleAlsoAsk:string,relatedSearches:string>")
BRANCHES = ("struct<name:string,slogan:string,infoEmpresa:string,emails:array<string>,contactMap:struct<WHATSAPP:array<string>>,mainPhone:struct<phoneToShow:string>,"
            "mainAddress:struct<mainAddressName:string,addressLocality:string,streetName:string,streetNumber:string,latitude:string,longitude:string,"
            "allPhonesList:array<struct<phoneToShow:string,number:string>>,allPhones:array<struct<phoneToShow:string,number:string>>,phones:array<struct<phoneToShow:string,number:string>>>,"
            "allAddresses:array<struct<mainAddressName:string,addressLocality:string,streetName:string,streetNumber:string,latitude:string,longitude:string,"
            "allPhonesList:array<struct<phoneToShow:string,number:string>>,allPhones:array<struct<phoneToShow:string,number:string>>,phones:array<struct<phoneToShow:string,number:string>>>>>")
PLACE = ("struct<fsq_place_id:string,name:string,latitude:double,longitude:double,location:struct<formatted_address:string,address:string,postcode:string,locality:string,region:string,country:string>,"
         "tel:string,email:string,website:string,categories:array<struct<id:string,name:string>>,date_refreshed:string,description:string,hours:map<string,string>>")
OSM = "struct<type:string,id:bigint,lat:double,lon:double,center:struct<lat:double,lon:double>,tags:map<string,string>>"
OWNERS = "array<struct<CODIGO_CLASE_IDENTIFICACION:string,NUMERO_IDENTIFICACION:string,RAZON_SOCIAL:string,FECHA_MATRICULA:string>>"


def first_key(m: Column, names: list[str]) -> Column:
    """The value of the first listed key that is present and not blank."""
    return F.coalesce(*(F.nullif(F.try_element_at(m, F.lit(n)), F.lit("")) for n in names))


def flatten_search(d: DataFrame, payload: str = "payload") -> DataFrame:
    """One row for the knowledge panel, at position 0, and one per organic result."""
    p = F.from_json(payload, SEARCH)
    k = p["knowledgeGraph"]
    row = lambda kind, title, url, snippet, position, phone: F.struct(F.lit(kind).alias("result_type"), title.alias("title"), url.alias("url"), snippet.alias("snippet"), position.cast("int").alias("position"), phone.alias("phone"))
    none = F.lit(None).cast("string")
    panel = F.when(k.isNotNull(), F.array(row("knowledgeGraph", k["title"], F.coalesce(F.nullif(k["website"], F.lit("")), k["descriptionLink"]), k["description"], F.lit(0), first_key(k["attributes"], X.ATTRIBUTE_PHONES))))
    organic = F.transform(p["organic"], lambda o: row("organic", o["title"], o["link"], o["snippet"], o["position"], none))
    empty = F.array().cast("array<struct<result_type:string,title:string,url:string,snippet:string,position:int,phone:string>>")
    return d.withColumn("__r", F.explode(F.concat(F.coalesce(panel, empty), F.coalesce(organic, empty)))).select(*d.columns, "__r.*")


def flatten_branches(d: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per address of a yellow-pages listing (its main address if there is no list)."""
    p = F.from_json(payload, BRANCHES)
    d = d.withColumn("__p", p)
    rows = F.explode(F.when(F.size("__p.allAddresses") > 0, F.col("__p.allAddresses")).otherwise(F.array("__p.mainAddress")))
    d = d.withColumn("a", rows)
    full = lambda c: F.when(F.size(c) > 0, c)
    phones = F.coalesce(full(F.col("a.allPhonesList")), full(F.col("a.allPhones")), full(F.col("a.phones")))
    numbers = F.filter(F.transform(phones, lambda x: F.coalesce(F.nullif(x["phoneToShow"], F.lit("")), x["number"])), lambda x: x.isNotNull() & (x != ""))
    address = F.nullif(F.trim(F.concat_ws(" ", "a.streetName", "a.streetNumber")), F.lit(""))
    out = d.select(*(c for c in d.columns if c not in ("__p", "a", payload)), F.col("__p.name").alias("name"), F.coalesce(F.nullif(F.col("a.mainAddressName"), F.lit("")), F.nullif(F.col("a.addressLocality"), F.lit("")), F.lit("Principal")).alias("branch"),
                   F.col("a.addressLocality").alias("place"), address.alias("address"), F.coalesce(F.nullif(F.array_join(numbers, " / "), F.lit("")), F.col("__p.mainPhone.phoneToShow")).alias("phone"),
                   X.to_coordinate(F.col("a.latitude")).alias("lat"), X.to_coordinate(F.col("a.longitude")).alias("lon"), F.try_element_at("__p.emails", F.lit(1)).alias("email"))
    return out.where(~F.coalesce(F.lower("address").startswith("atiende en"), F.lit(False)))


def flatten_place(d: DataFrame, departments: dict[str, str], payload: str = "payload", city: str = "search_city", seen: str = "extracted") -> DataFrame:
    """A places-API record per row; rows without id or name go. departments: search city to department."""
    p = F.from_json(payload, PLACE)
    d = d.withColumn("p", p).where("p.fsq_place_id is not null and p.name is not null")
    known = F.create_map(*(F.lit(x) for pair in (departments or {"": ""}).items() for x in pair))
    names = F.array_join(F.transform("p.categories", lambda c: c["name"]), ", ")
    return d.select(F.col("p.fsq_place_id").alias("place_id"), F.col("p.name").alias("name"), F.coalesce(F.nullif(F.col("p.location.locality"), F.lit("")), F.col(city)).alias("place"),
                    F.coalesce(F.try_element_at(known, F.lower(city)), F.col("p.location.region")).alias("department"), F.coalesce("p.location.formatted_address", "p.location.address").alias("address"),
                    F.col("p.latitude").alias("lat"), F.col("p.longitude").alias("lon"), F.col("p.tel").alias("phone"), F.col("p.email").alias("email"), F.col("p.website").alias("website"), names.alias("categories"),
                    F.array_join(F.transform("p.categories", lambda c: c["id"]), ", ").alias("category_ids"), F.to_json("p.hours").alias("hours"),
                    F.coalesce(F.try_to_timestamp("p.date_refreshed", F.lit("yyyy-MM-dd")), F.col(seen).cast("timestamp")).alias("refreshed"), X.listing_hash(F.lit("fsq"), F.col("p.fsq_place_id")).alias("hash_id"))


def flatten_osm(d: DataFrame, payload: str = "payload") -> DataFrame:
    """A map element per row; elements without type or id, or of an excluded shop kind, go."""
    d = d.withColumn("p", F.from_json(payload, OSM)).where("p.type is not null and p.id is not null")
    t = F.col("p.tags")
    d = d.where(~F.coalesce(first_key(t, ["shop"]).isin(OSM_EXCLUDED_SHOPS), F.lit(False)))
    street = F.nullif(F.trim(F.concat_ws(" ", first_key(t, ["addr:street"]), first_key(t, ["addr:housenumber"]))), F.lit(""))
    return d.select(F.col("p.type").alias("osm_type"), F.col("p.id").alias("osm_id"), first_key(t, ["name", "brand", "operator"]).alias("name"), F.coalesce("p.lat", "p.center.lat").alias("lat"),
                    F.coalesce("p.lon", "p.center.lon").alias("lon"), first_key(t, ["phone", "contact:phone", "contact:mobile"]).alias("phone"), first_key(t, ["email", "contact:email"]).alias("email"),
                    first_key(t, ["website", "contact:website", "url"]).alias("website"), first_key(t, ["shop"]).alias("shop"), F.coalesce(street, first_key(t, ["addr:full"])).alias("address"),
                    first_key(t, ["addr:city"]).alias("place"), F.md5(F.concat_ws("|", F.lit("overpass"), "p.type", F.col("p.id").cast("string"))).alias("hash_id"))


def flatten_register(d: DataFrame) -> DataFrame:
    """Register detail: commercial before fiscal contacts, phones in one form, dates parsed."""
    pick = lambda *c: F.coalesce(F.lit(None).cast("string"), *(F.nullif(F.trim(x), F.lit("")) for x in c if x in d.columns))
    dates = [c for c in d.columns if c.startswith("fecha_")]
    return d.withColumns({"name": F.col("razon_social"), "place": pick("mun_comercial", "mun_fiscal"), "address": pick("dir_comercial", "dir_fiscal", "direccion"),
                          "phone": X.phone_e164(pick("tel_com_1", "tel_com_2", "telefono")), "email": pick("email_com", "correo_electronico")} | {c: X.parse_yyyymmdd(F.col(c)) for c in dates})


def flatten_owners(d: DataFrame, payload: str = "owners", every: bool = False) -> DataFrame:
    """The owners of a register entry: the first, or all of them."""
    o = F.from_json(payload, OWNERS)
    rows = F.explode_outer(o) if every else F.try_element_at(o, F.lit(1))
    d = d.withColumn("o", rows)
    return d.select(*(c for c in d.columns if c not in ("o", payload)), F.col("o.NUMERO_IDENTIFICACION").alias("owner_id"), F.col("o.RAZON_SOCIAL").alias("owner"), X.parse_yyyymmdd(F.col("o.FECHA_MATRICULA")).alias("registered"))
