"""Province groups: stable ids, display names and the spellings that map to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Group id -> display name.
GROUP_NAMES = {
    "a-coruna": "A Coruña", "albacete": "Albacete", "alicante": "Alicante",
    "almeria": "Almería", "araba-alava": "Araba/Álava", "asturias": "Asturias",
    "avila": "Ávila", "badajoz": "Badajoz", "baleares": "Illes Balears",
    "barcelona": "Barcelona", "bizkaia": "Bizkaia", "burgos": "Burgos",
    "caceres": "Cáceres", "cadiz": "Cádiz", "cantabria": "Cantabria",
    "castellon": "Castellón", "ceuta": "Ceuta", "ciudad-real": "Ciudad Real",
    "cordoba": "Córdoba", "cuenca": "Cuenca", "gipuzkoa": "Gipuzkoa",
    "girona": "Girona", "granada": "Granada", "guadalajara": "Guadalajara",
    "huelva": "Huelva", "huesca": "Huesca", "jaen": "Jaén", "la-rioja": "La Rioja",
    "las-palmas": "Las Palmas", "leon": "León", "lleida": "Lleida", "lugo": "Lugo",
    "madrid": "Madrid", "malaga": "Málaga", "melilla": "Melilla", "murcia": "Murcia",
    "navarra": "Navarra", "ourense": "Ourense", "palencia": "Palencia",
    "pontevedra": "Pontevedra", "salamanca": "Salamanca",
    "santa-cruz-de-tenerife": "Santa Cruz de Tenerife", "segovia": "Segovia",
    "sevilla": "Sevilla", "soria": "Soria", "tarragona": "Tarragona",
    "teruel": "Teruel", "toledo": "Toledo", "valencia": "Valencia",
    "valladolid": "Valladolid", "zamora": "Zamora", "zaragoza": "Zaragoza",
}

# Spelling of the source -> group id.
ALIASES = {
    "A CORUÑA": "a-coruna", "ALBACETE": "albacete", "ALICANTE": "alicante",
    "ALMERIA": "almeria", "ARABA/ALAVA": "araba-alava", "ASTURIAS": "asturias",
    "AVILA": "avila", "BADAJOZ": "badajoz", "BALEARES": "baleares", "BARCELONA": "barcelona",
    "BIZKAIA": "bizkaia", "BURGOS": "burgos", "CACERES": "caceres", "CADIZ": "cadiz",
    "CANTABRIA": "cantabria", "CASTELLON": "castellon", "CEUTA": "ceuta",
    "CIUDAD REAL": "ciudad-real", "CORDOBA": "cordoba", "CUENCA": "cuenca",
    "GIPUZKOA": "gipuzkoa", "GIRONA": "girona", "GRANADA": "granada",
    "GUADALAJARA": "guadalajara", "HUELVA": "huelva", "HUESCA": "huesca",
    "ILLES BALEARS": "baleares", "JAEN": "jaen", "LA RIOJA": "la-rioja",
    "LAS PALMAS": "las-palmas", "LEON": "leon", "LLEIDA": "lleida", "LUGO": "lugo",
    "MADRID": "madrid", "MALAGA": "malaga", "MELILLA": "melilla", "MURCIA": "murcia",
    "NAVARRA": "navarra", "OURENSE": "ourense", "PALENCIA": "palencia",
    "PONTEVEDRA": "pontevedra", "SALAMANCA": "salamanca",
    "SANTA CRUZ DE TENERIFE": "santa-cruz-de-tenerife", "SEGOVIA": "segovia",
    "SEVILLA": "sevilla", "SORIA": "soria", "STA. CRUZ DE TENERIFE": "santa-cruz-de-tenerife",
    "TARRAGONA": "tarragona", "TERUEL": "teruel", "TOLEDO": "toledo", "VALENCIA": "valencia",
    "VALLADOLID": "valladolid", "ZAMORA": "zamora", "ZARAGOZA": "zaragoza",
}


def alias_pairs() -> list[tuple[str, str]]:
    return list(ALIASES.items())


def province_aliases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(alias_pairs(), "alias string, group_id string")


def province_names(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(GROUP_NAMES.items()), "group_id string, name string")
