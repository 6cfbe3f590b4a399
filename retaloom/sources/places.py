"""Map positions of the departments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Department, latitude, longitude.
COORDINATES = (
    ("Ancash", -9.53, -77.53),
    ("Apurimac", -13.63, -73.08),
    ("Arequipa", -16.41, -71.54),
    ("Ayacucho", -13.16, -74.22),
    ("Cajamarca", -7.16, -78.50),
    ("Cusco", -13.53, -71.97),
    ("Huancavelica", -12.79, -74.97),
    ("Huanuco", -9.93, -76.24),
    ("Ica", -14.07, -75.73),
    ("Junin", -12.07, -75.20),
    ("La Libertad", -8.11, -79.03),
    ("Lambayeque", -6.77, -79.84),
    ("Lima", -12.05, -77.04),
    ("Loreto", -3.75, -73.25),
    ("Madre de Dios", -12.59, -69.19),
    ("Moquegua", -17.19, -70.93),
    ("Pasco", -10.69, -75.21),
    ("Piura", -5.19, -80.63),
    ("Puno", -15.84, -70.02),
    ("San Martin", -6.04, -76.97),
    ("Tacna", -18.01, -70.25),
    ("Tumbes", -3.57, -80.45),
    ("Ucayali", -8.38, -74.55),
    ("Amazonas", -4.52, -77.87),
    ("Callao", -12.05, -77.13),
)
DEPARTMENTS = tuple(name for name, _, _ in COORDINATES)


def coordinates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(COORDINATES), "Departamento string, lat double, lon double")
