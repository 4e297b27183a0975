"""Prompt catalogues: small ordered dimensions that live on the driver.

A catalogue is configuration with a few entries, so it travels inside the plan
as literals. Fanning tracks out over it needs no join and no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from trackloom.model import CATEGORY_KEYS, DETAIL_KEYS

CATALOG_SCHEMA = T.StructType([
    T.StructField("prompt_set", T.StringType()),
    T.StructField("ord", T.IntegerType()),
    T.StructField("category", T.StringType()),
    T.StructField("prompt", T.StringType()),
])


@dataclass(frozen=True)
class Catalog:
    """Ordered (category, prompt) entries under one name."""

    name: str
    entries: tuple[tuple[str, str], ...]

    def __post_init__(self):
        if len(set(self.keys)) != len(self.entries):
            raise ValueError("categories must be unique")

    @property
    def keys(self) -> list[str]:
        return [category for category, _ in self.entries]

    def subset(self, names: str | list[str]) -> "Catalog":
        """The named categories in the order asked for; unknown names reject the run."""
        if names == "all":
            return self
        wanted = names.split(",") if isinstance(names, str) else names
        wanted = list(dict.fromkeys(n.strip() for n in wanted if n.strip()))
        unknown = [n for n in wanted if n not in self.keys]
        if unknown:
            raise ValueError(f"Unknown categories {unknown}. Available: {self.keys}")
        prompts = dict(self.entries)
        return Catalog(self.name, tuple((n, prompts[n]) for n in wanted))

    def as_array(self) -> Column:
        """array<struct<ord, category, prompt>> of literals."""
        return F.array(*[
            F.struct(F.lit(i).alias("ord"), F.lit(c).alias("category"), F.lit(p).alias("prompt"))
            for i, (c, p) in enumerate(self.entries)
        ])

    def keys_array(self) -> Column:
        return F.array(*[F.lit(k) for k in self.keys])

    def prompt_for(self, category: Column | str) -> Column:
        """Prompt lookup by category; null for a category that is not listed."""
        pairs = [F.lit(x) for entry in self.entries for x in entry]
        key = F.col(category) if isinstance(category, str) else category
        return F.try_element_at(F.create_map(*pairs), key)

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [(self.name, i, c, p) for i, (c, p) in enumerate(self.entries)]
        return spark.createDataFrame(rows, CATALOG_SCHEMA)


def read_catalog(spark: SparkSession, path: str, name: str) -> Catalog:
    """A catalogue from JSON lines with the columns of ``CATALOG_SCHEMA``: configuration, read by the driver."""
    rows = (
        spark.read.schema(CATALOG_SCHEMA).json(path)
        .where(F.col("prompt_set") == name).orderBy("ord").collect()
    )
    return Catalog(name, tuple((r["category"], r["prompt"]) for r in rows))


KEYED = Catalog("keyed", tuple(zip(CATEGORY_KEYS, [
    "Name the genre, its subgenres and the tempo feel of this recording.",
    "Describe the voice: range, technique, delivery, language and layers.",
    "List the instruments from most to least prominent and how each is played.",
    "Describe stereo image, reverberation, dynamics and artefacts of the mix.",
    "Judge loudness, tonal balance and width of the finished master.",
])))

DETAILED = Catalog("detailed", tuple(zip(DETAIL_KEYS, [
    "Give genre, subgenre and regional style as comma-separated noun phrases.",
    "Give every instrument with its technique as comma-separated noun phrases.",
    "Give voice type, delivery and ornaments as comma-separated noun phrases.",
    "Give tempo in BPM, key and time signature as comma-separated noun phrases.",
])))

QUICK = Catalog("quick", ((
    "summary",
    "Give genre, instruments, percussion, bass, vocals, BPM, key and time signature "
    "as one comma-separated string of noun phrases.",
),))

MODE_PROMPTS = {
    "minimal": "List what you hear: instruments, voice, tempo and melodic intervals. Do not infer.",
    "default": "Describe genre, tempo, key, instruments, production and mood in full detail.",
}
