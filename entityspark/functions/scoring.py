"""Relevance by weighted keywords: every term counts once if the text contains it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from entityspark.functions.text import domain_of, strip_accents

# The rule sets of the six directory sources, (weight, terms), their bonuses and thresholds.
# Brand names are the caller's to add: MAPS + [(3, [...])].
MAPS = [
    (3, ["cemento", "concreto", "premezclado", "mortero", "morteros", "agregados", "arena", "balasto", "obra gris", "bloquera", "ladrillera", "prefabricado",
         "distribuidor de cemento", "material de construccion", "materiales de construccion", "deposito de materiales", "deposito y ferreteria", "ferredeposito",
         "ferredepositos", "centro ferretero", "bodegas de construccion", "hierro y cemento"]),
    (2, ["ferreteria", "ferreterias", "ferretero", "materiales", "construccion", "deposito", "bloques", "hierro", "ferreteria y deposito", "construcciones",
         "contratista", "obra", "ladrillo"]),
    (-5, ["cerrajeria", "cerrajero", "pinturas", "pintura", "electricos", "electricista", "ornamentacion", "ornamentador", "alquiler de equipos", "ropa", "comida",
          "taxis", "salon de belleza", "restaurante", "supermercado", "vidrios", "vidrieria", "plomeria", "fontaneria", "refrigeracion", "aires acondicionados",
          "electro", "electrico", "electrica", "electricas", "automotriz", "automotor", "iluminacion", "luminarias", "gas natural", "gases industriales",
          "zapateria", "calzado", "camaras de seguridad", "sistema de seguridad", "papeleria", "miscelanea"])]
YELLOW_PAGES = [
    (3, ["cemento", "concreto", "mortero", "agregado", "agregados", "obra gris", "prefabricado", "prefabricados", "bloquera", "bloques", "ladrillos", "ladrillera",
         "deposito de materiales", "depósito de materiales"]),
    (2, ["ferreteria", "ferretería", "materiales", "construccion", "construcción", "deposito", "depósito", "hierro", "corralon", "corralón", "arena", "grava",
         "triturado", "distribuidor", "distribuidora"]),
    (1, ["constructora", "acabados", "proveedor", "suministros", "estructuras"]),
    (-3, ["cerrajeria", "cerrajería", "pintura decorativa", "pinturas decorativas", "plomería residencial", "plomeria residencial", "mecanico", "mecánico",
          "taller automotriz", "restaurante", "comidas", "supermercado", "tienda de ropa"])]
PLACES = [
    (3, ["ferreteri", "cemento", "concreto", "mortero", "prefabricado", "bloquera", "ladrillera", "deposito materiales", "distribuidor cemento", "obra gris",
         "hierro cemento", "agregados", "ferredeposito", "centro ferretero", "materiales construccion"]),
    (2, ["construccion", "deposito", "materiales", "hierro", "hardware", "building", "corralon"]),
    (-5, ["restaurante", "salon belleza", "spa", "medico", "farmacia", "ropa", "hotel", "veterinaria", "supermercado"])]
PLACE_CATEGORY_BONUS = {"4bf58dd8d48988d112951735": 5, "52f2ab2ebcbc57f1066b8b43": 3, "4d954b0ea243a5684a65b473": 1}
REGISTER = [
    (3, ["ferreter", "deposito materiales", "materiales construccion", "cemento", "concreto", "mortero", "prefabricado", "bloquera", "ladrillera",
         "distribuidor cemento", "obra gris", "hierro cemento", "agregados", "ferredeposito", "centro ferretero"]),
    (2, ["construccion", "deposito", "materiales", "hierro", "hardware"]),
    (-5, ["restaurante", "salon belleza", "spa", "medico", "farmacia", "ropa", "hotel"])]
REGISTER_CODES = ["4752", "4753", "4659", "4690", "2394", "2395", "2310", "1610", "2399"]
OSM_POSITIVE = ["ferreter", "cemento", "concreto", "mortero", "prefabric", "bloquera", "ladriller", "deposito", "material construccion"]
OSM_NEGATIVE = ["droguer", "farmac", "veterinar", "lubricant", "aceite motor", "cafeter", "cafetero", "panaderi", "carnicer", "ropa", "calzado", "optic", "joyeri",
                "florist", "lavanderi", "tintoreri", "televis", "celular", "computad", "licor", "licorer", "cigarr", "tabac", "barberi", "salon de bell",
                "estetica", "taller autom", "llantera"]
OSM_FAMILY = {"hardware": 5, "building_materials": 5, "trade_supplies": 1, "doityourself": 1}
OSM_EXCLUDED_SHOPS = ["pharmacy", "chemist", "fuel", "gas_station", "car_repair", "auto_parts", "veterinary", "pet", "supermarket", "convenience", "bakery", "butcher",
                      "clothes", "beauty", "electronics", "mobile_phone", "coffee", "cafe", "florist", "optician", "laundry", "dry_cleaning", "car_wash", "alcohol",
                      "tobacco", "books", "jewelry", "shoes"]
WEB_SEARCH = [
    (3, ["ferreter", "deposito de materiales", "deposito y ferreteria", "materiales de construccion", "materiales para construccion", "cemento", "concreto",
         "mortero", "prefabricado", "bloquera", "ladrillera", "distribuidor de cemento", "distribuidora de cemento", "obra gris", "hierro y cemento", "agregados",
         "ferredeposito", "centro ferretero", "bodegas de construccion"]),
    (2, ["construccion", "deposito", "corralon", "materiales", "hierro", "arena", "grava", "triturado", "ferretero"]),
    (-5, ["restaurante", "comida", "estetica", "spa", "medico", "odontologia", "ropa", "moda", "peluqueria", "barberia", "hotel", "turismo", "veterinaria",
          "abogado", "universidad", "colegio", "farmacia", "salon de belleza", "taxis", "supermercado"])]
WEB_DOMAINS = ["ferreter", "constructor", "cement", "concreto", "materiales"]
THRESHOLD, WEB_THRESHOLD = 2, 3


def score_keywords(text: Column, rules: list[tuple[int, list[str]]]) -> Column:
    """Sum of the weights of the terms that text contains. Null text scores 0."""
    text = F.coalesce(text, F.lit(""))
    total = F.lit(0)
    for weight, terms in rules:
        for term in terms:
            total = total + F.when(text.contains(term), weight).otherwise(0)
    return total


def _joined(*parts: Column) -> Column:
    return F.lower(F.concat_ws(" ", *(F.coalesce(p, F.lit("")) for p in parts)))


def maps_score(name: Column, categories: Column, keyword: Column) -> Column:
    return score_keywords(strip_accents(_joined(name, F.array_join(categories, " "), keyword)), MAPS)


def yellow_pages_score(name: Column, description: Column, keyword: Column) -> Column:
    return score_keywords(_joined(name, description, F.replace(keyword, F.lit("-"), F.lit(" "))), YELLOW_PAGES)


def places_score(name: Column, description: Column, categories: Column) -> Column:
    """categories: array of structs with id and name; every occurrence of a listed id counts."""
    bonus = F.create_map(*(F.lit(x) for pair in PLACE_CATEGORY_BONUS.items() for x in pair))
    extra = F.aggregate(categories, F.lit(0), lambda a, c: a + F.coalesce(F.try_element_at(bonus, c["id"]), F.lit(0)))
    return score_keywords(_joined(name, description, F.array_join(F.transform(categories, lambda c: c["name"]), " ")), PLACES) + F.coalesce(extra, F.lit(0))


def register_score(legal: Column, description: Column, code: Column) -> Column:
    return score_keywords(_joined(legal, description), REGISTER) + F.when(code.isin(REGISTER_CODES), 5).otherwise(0)


def osm_score(name: Column, family: Column) -> Column:
    """The family's base; one negative word takes 10; positive words count only while the score is not negative."""
    text = F.lower(F.coalesce(name, F.lit("")))
    base = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for pair in OSM_FAMILY.items() for x in pair)), family), F.lit(0))
    bad = F.lit(False)
    for term in OSM_NEGATIVE:
        bad = bad | text.contains(term)
    base = base - F.when(bad, 10).otherwise(0)
    return base + F.when(base >= 0, score_keywords(text, [(2, OSM_POSITIVE)])).otherwise(0)


def web_score(title: Column, snippet: Column, meta: Column, query: Column, url: Column) -> Column:
    domain, hit = domain_of(url), F.lit(False)
    for stem in WEB_DOMAINS:
        hit = hit | F.coalesce(domain.contains(stem), F.lit(False))
    return score_keywords(_joined(title, snippet, meta, query, url), WEB_SEARCH) + F.when(hit, 2).otherwise(0)
