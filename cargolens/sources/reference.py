"""Small fixed reference tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolens import schemas as S
from cargolens.functions.text import padded_id

# The four warehouses (name, city, country, latitude, longitude, capacity).
WAREHOUSES = [
    ("Amsterdam Distribution Centre", "Amsterdam", "Netherlands", 52.3676, 4.9041, 50000),
    ("Berlin Fulfilment Hub", "Berlin", "Germany", 52.5200, 13.4050, 75000),
    ("Paris Logistics Centre", "Paris", "France", 48.8566, 2.3522, 60000),
    ("Madrid Shipping Hub", "Madrid", "Spain", 40.4168, -3.7038, 45000),
]

# Cities (city, state, country, latitude, longitude).
CITIES = [
    ("Amsterdam", "North Holland", "Netherlands", 52.3676, 4.9041),
    ("Rotterdam", "South Holland", "Netherlands", 51.9244, 4.4777),
    ("Berlin", "Berlin", "Germany", 52.5200, 13.4050),
    ("Munich", "Bavaria", "Germany", 48.1351, 11.5820),
    ("Hamburg", "Hamburg", "Germany", 53.5511, 9.9937),
    ("Paris", "Île-de-France", "France", 48.8566, 2.3522),
    ("Lyon", "Auvergne-Rhône-Alpes", "France", 45.7640, 4.8357),
    ("Marseille", "Provence", "France", 43.2965, 5.3698),
    ("Madrid", "Madrid", "Spain", 40.4168, -3.7038),
    ("Barcelona", "Catalonia", "Spain", 41.3874, 2.1686),
    ("Valencia", "Valencia", "Spain", 39.4699, -0.3763),
    ("Rome", "Lazio", "Italy", 41.9028, 12.4964),
    ("Milan", "Lombardy", "Italy", 45.4642, 9.1900),
    ("Naples", "Campania", "Italy", 40.8518, 14.2681),
    ("Warsaw", "Masovia", "Poland", 52.2297, 21.0122),
    ("Krakow", "Lesser Poland", "Poland", 50.0647, 19.9450),
    ("Stockholm", "Stockholm", "Sweden", 59.3293, 18.0686),
    ("Gothenburg", "Västra Götaland", "Sweden", 57.7089, 11.9746),
    ("Vienna", "Vienna", "Austria", 48.2082, 16.3738),
    ("Brussels", "Brussels", "Belgium", 50.8503, 4.3517),
    ("Antwerp", "Flanders", "Belgium", 51.2194, 4.4025),
    ("Copenhagen", "Capital Region", "Denmark", 55.6761, 12.5683),
    ("Lisbon", "Lisbon", "Portugal", 38.7223, -9.1393),
    ("Porto", "Porto", "Portugal", 41.1579, -8.6291),
    ("Prague", "Prague", "Czechia", 50.0755, 14.4378),
    ("Budapest", "Budapest", "Hungary", 47.4979, 19.0402),
    ("Dublin", "Leinster", "Ireland", 53.3498, -6.2603),
    ("Helsinki", "Uusimaa", "Finland", 60.1699, 24.9384),
    ("Athens", "Attica", "Greece", 37.9838, 23.7275),
    ("Zurich", "Zurich", "Switzerland", 47.3769, 8.5417),
]


def reference_warehouses(spark: SparkSession, count: int = 4) -> DataFrame:
    """The first `count` warehouses, numbered from WH-001."""
    if count > len(WAREHOUSES):
        raise ValueError(f"{count} warehouses asked for, the table has {len(WAREHOUSES)}")
    rows = [(number, *row) for number, row in enumerate(WAREHOUSES[:count], start=1)]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.WAREHOUSES[1:])
    numbered = spark.createDataFrame(rows, f"number int, {fields}")
    return numbered.select(padded_id("WH", F.col("number")).alias("warehouse_id"),
                           *S.WAREHOUSES.fieldNames()[1:])


def cities(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        CITIES, "city string, state string, country string, latitude double, longitude double")
