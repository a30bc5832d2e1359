"""The corpus pipeline: documents from raw to packed sequences, each stage stored before the next.

Every stage takes all that its predecessor kept. All but the last return the columns of
``documents``; mixing repeats a row as often as the mix takes it.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.llm import simhash
from tarnlake.llm.common import prepare, stored
from tarnlake.llm.lines import line_dedup
from tarnlake.llm.mixing import mix
from tarnlake.llm.packing import pack
from tarnlake.llm.quality import quality_rules
from tarnlake.llm.queries import TOKENIZER, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go, null and empty texts with them (under 50 words).

    Null and repeated ids are judged row by row; of an empty table nothing is left.
    """
    return quality_rules(docs, table(spark, sf_dir, "labels")).where("kept").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose lines that an earlier document holds; ``n_chars`` follows the text.

    No row goes: a text may end up empty, a null text becomes empty. A null id comes after all
    others. An empty table gives an empty result.
    """
    kept = line_dedup(docs)
    return kept.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, the one with the least id and text digest.

    Null and repeated ids are told apart by row: unlike texts under one id, or under none, all stay.
    """
    prepare(spark)
    return simhash.drop_near_copies(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, from not at all to three times.

    Null sources are one source. A text without words costs the target nothing and comes as often
    as all of its source do at least, be that once. An empty table gives an empty result.
    """
    prepare(spark)
    mixed = mix(docs).where("copies > 0")
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences with their token ids; each row that comes is packed for itself.

    A null or empty text is its end token alone. Null and repeated ids pass through; an empty
    table gives an empty result.
    """
    return pack(docs, TOKENIZER)


STAGES = [
    ("quality_rules", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("simhash_dedup", drop_near_copies),
    ("source_mix", mix_sources),
    ("packing", pack_sequences),
]

#: Hashed multinomials, XXH64 shingles and a tokenizer are beyond SQL; the tests compare each
#: stage with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
