"""Driver tables in the shape of raw bioactivity entities.

Column values are attribute mappings (a CASE over a column gives the NULLs, labels and
unreadable texts real sources have); every row of the given tables takes part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import STANDARD_TYPES, XREF_SOURCES, CLASS_LABELS, TargetSet
from ..functions.fingerprint import bits_to_hex, word_set
from ..functions.scalar import round_fp
from ..operators.fingerprints import set_bits
from ..session import spread
from .warehouse import Warehouse

NBITS = 64

# Nations stand for targets; three of their five regions have a payload class.
ANALOG_CLASSES = tuple(
    (f"T{k}", ("tubulin_inhibitor", "topo1_inhibitor", "topo2_inhibitor")[k % 5]) for k in range(25) if k % 5 < 3
)
ANALOG = TargetSet(
    release="36",
    organism="Homo sapiens",
    standard_types=STANDARD_TYPES,
    min_confidence=5,
    payload_classes=ANALOG_CLASSES,
    xref_sources=XREF_SOURCES,
    cliff_min_tanimoto=0.5,
    cliff_min_delta=0.5,
    fingerprint_bits=NBITS,
    class_labels=CLASS_LABELS,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tag(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    potency = round_fp(-F.log10(F.col("l_extendedprice") * F.lit(1e-9)), 2)
    endpoint = F.when(F.col("l_returnflag") == "A", "IC50").when(F.col("l_returnflag") == "N", "Ki").otherwise("Inhibition")
    return table(spark, sf_dir, "lineitem").join(suppliers, "l_suppkey").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("activity_id"),
        _tag("M", "l_partkey").alias("molecule_chembl_id"),
        _tag("T", "s_nationkey").alias("target_chembl_id"),
        _tag("A", "l_orderkey").alias("assay_chembl_id"),
        endpoint.alias("standard_type"),
        F.when(F.col("l_linestatus") == "O", "=").otherwise(">").alias("standard_relation"),
        F.col("l_extendedprice").alias("standard_value"),
        F.lit("nM").alias("standard_units"),
        F.when(F.col("l_quantity") != 1.0, potency).alias("pchembl_value"),
        F.when(F.col("l_discount") >= 0.1, "Outside typical range").alias("data_validity_comment"),
        _tag("D", "l_suppkey").alias("document_chembl_id"),
    )


def molecules(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    array = F.concat(
        F.lit('[{"xref_src":"PubChem","xref_id":"'),
        F.col("p_partkey").cast("string"),
        F.lit('","xref_name":"n"},{"xref_src":"PDBe","xref_id":"L'),
        size.cast("string"),
        F.lit('","xref_name":null},{"xref_src":null,"xref_id":"z"}]'),
    )
    refs = (
        F.when(size % 6 == 0, F.lit(None).cast("string"))
        .when(size % 6 == 1, F.lit("null"))
        .when(size % 6 == 2, F.lit("[]"))
        .when(size % 6 == 3, F.lit('{"xref_src":"PDBe","xref_id":"L1"}'))
        .otherwise(array)
    )
    d = "molecule_properties."
    return table(spark, sf_dir, "part").select(
        _tag("M", "p_partkey").alias("molecule_chembl_id"),
        F.when(size % 7 != 0, F.col("p_name")).alias("pref_name"),
        F.when(size % 5 != 0, (size % 6).cast("double")).alias("max_phase"),
        F.col("p_type").alias("molecule_type"),
        refs.alias("cross_references"),
        F.when(size != 50, F.concat_ws("-", "p_brand", "p_type", "p_name")).alias("molecule_structures.canonical_smiles"),
        F.md5("p_name").alias("molecule_structures.standard_inchi_key"),
        F.col("p_retailprice").alias(f"{d}mw_freebase"),
        (size.cast("double") / 10 - 1).alias(f"{d}alogp"),
        (size % 12).cast("int").alias(f"{d}hba"),
        (size % 8).cast("int").alias(f"{d}hbd"),
        F.when(size % 9 != 0, F.col("p_retailprice") * 0.5).alias(f"{d}psa"),
        F.length("p_name").cast("int").alias(f"{d}rtb"),
        F.when(size % 9 != 0, (size % 5).cast("int")).alias(f"{d}num_ro5_violations"),
        F.when(size < 10, "Y").otherwise("N").alias(f"{d}ro3_pass"),
        (size % 4).cast("int").alias(f"{d}aromatic_rings"),
        (size.cast("double") / 50).alias(f"{d}qed_weighted"),
    )


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = F.col("n_regionkey")
    return table(spark, sf_dir, "nation").select(
        _tag("T", "n_nationkey").alias("target_chembl_id"),
        F.col("n_name").alias("pref_name"),
        F.when(region == 4, "Rattus norvegicus").otherwise("Homo sapiens").alias("organism"),
        F.when(region == 0, "PROTEIN FAMILY").otherwise("SINGLE PROTEIN").alias("target_type"),
        (region + 9606).cast("bigint").alias("tax_id"),
    )


def _priority() -> Column:
    return F.substring("o_orderpriority", 1, 1).cast("int")


def assays(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("o_orderstatus") == "F", "F").when(F.col("o_orderstatus") == "O", "B").otherwise("A")
    return table(spark, sf_dir, "orders").select(
        _tag("A", "o_orderkey").alias("assay_chembl_id"),
        F.col("o_orderpriority").alias("description"),
        kind.alias("assay_type"),
        F.concat((F.lit(8) - _priority()).cast("string"), F.lit(".0")).alias("confidence_score"),
        F.lit(None).cast("string").alias("target_chembl_id"),
    )


def cell_activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    user, event, kind = F.col("user_id"), F.col("event_id"), F.col("event_type")
    units = (
        F.when(event % 5 == 0, "nM").when(event % 5 == 1, "uM").when(event % 5 == 2, "M").when(event % 5 == 3, "pM")
    ).otherwise("ug/mL")
    return table(spark, sf_dir, "events").select(
        event.alias("activity_id"),
        _tag("M", "user_id").alias("molecule_chembl_id"),
        F.when(user % 7 != 0, F.concat(F.lit("Molecule "), user.cast("string"))).alias("molecule_pref_name"),
        F.lit(None).cast("string").alias("canonical_smiles"),
        F.when(user % 3 == 0, "tubulin_inhibitor").otherwise("topo1_inhibitor").alias("payload_class"),
        F.concat(F.lit("Ref"), (user % 10).cast("string")).alias("reference_name"),
        F.concat(F.lit("C_"), kind).alias("target_chembl_id"),
        kind.alias("target_pref_name"),
        _tag("A", "event_id").alias("assay_chembl_id"),
        F.when(kind.isin("view", "click"), "GI50").when(kind == "error", "Potency").otherwise("IC50").alias("standard_type"),
        F.when(F.col("value") < 1, ">").otherwise("=").alias("standard_relation"),
        F.col("value").alias("standard_value"),
        units.alias("standard_units"),
    )


def xref_unichem(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc_id")
    source = F.when(doc % 4 == 0, "pubchem").when(doc % 4 == 1, "pdbe").when(doc % 4 == 2, "drugbank").otherwise("newDb")
    return table(spark, sf_dir, "documents").select(
        _tag("M", "doc_id").alias("molecule_chembl_id"),
        source.alias("source"),
        F.when(F.col("n_chars") % 11 != 0, F.concat(F.lit("L"), (doc % 50).cast("string"))).alias("xref_id"),
    )


def pdbe_structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        _tag("L", "user_id").alias("xref_id"),
        F.when(F.col("event_type") != "signup", _tag("p", "event_id")).alias("pdb_id"),
    )


def pdbe_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    pending, p = F.col("o_orderstatus") == "P", _priority()
    method = (
        F.when(p == 1, "X-ray diffraction").when(p == 2, "Electron Microscopy").when(p == 3, "Solution NMR").when(p == 4, "Other")
    )
    return table(spark, sf_dir, "orders").select(
        _tag("P", "o_orderkey").alias("pdb_id"),
        F.when(~pending, _tag("Entry ", "o_orderkey")).alias("title"),
        method.alias("method"),
        F.when(pending, "n/a").otherwise(F.year("o_orderdate").cast("string")).alias("year"),
        F.when(p == 5, "unknown").otherwise(round_fp(F.col("o_totalprice") / 100000, 2).cast("string")).alias("resolution"),
    )


def compound_cheminfo(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("vec_id"), "p_brand", "p_type", "p_size")
    vectors = table(spark, sf_dir, "embeddings").withColumn("bits", set_bits("embedding"))
    cyclic = F.col("p_size") % 10 != 0
    return vectors.join(parts, "vec_id", "left").select(
        _tag("M", "vec_id").alias("molecule_chembl_id"),
        F.lit(None).cast("string").alias("canonical_smiles"),
        bits_to_hex("bits", NBITS).alias("ecfp4_hex"),
        F.col("bits").alias("ecfp4_onbits"),
        F.size("bits").alias("n_onbits"),
        (F.col("label") + 10).alias("heavy_atom_count"),
        F.when(cyclic, F.concat_ws(" ", "p_brand", "p_type")).alias("murcko_scaffold_smiles"),
        F.when(cyclic, F.col("p_type")).alias("murcko_generic_smiles"),
    )


def compound_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    def coordinate(i: int) -> Column:
        return round_fp(F.get("embedding", F.lit(i)).cast("double"), 4)

    return table(spark, sf_dir, "embeddings").select(
        _tag("M", "vec_id").alias("molecule_chembl_id"), coordinate(0).alias("umap_x"), coordinate(1).alias("umap_y")
    )


ENTITIES = {
    "activities": activities,
    "cell_activities": cell_activities,
    "molecules": molecules,
    "targets": targets,
    "assays": assays,
    "xref_unichem": xref_unichem,
    "pdbe_structures": pdbe_structures,
    "pdbe_summary": pdbe_summary,
    "compound_cheminfo": compound_cheminfo,
    "compound_embedding": compound_embedding,
}


class _Raw(dict):
    """Raw frames made on first use, so a query only touches the tables it reads."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        super().__init__()
        self._args = (spark, sf_dir)

    def __missing__(self, entity: str) -> DataFrame:
        self[entity] = ENTITIES[entity](*self._args)
        return self[entity]


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse(_Raw(spark, sf_dir), ANALOG)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts, spread over the cores before they are tokenised."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "text", "n_chars"))


def document_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as entities: word set of the whole text, language as group."""
    return documents(spark, sf_dir).select(
        "doc_id", "lang", (F.col("doc_id") % 7).cast("double").alias("potency"), word_set("text").alias("words")
    )
