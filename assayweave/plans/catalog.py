"""Registered queries: each operator on the driver tables, with its DuckDB definition.

Every double is rounded to at most six places on both sides, because sums and logarithms
may differ in the last bit between engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import functions as fn
from ..operators import dimensions as dims
from ..operators import (
    fingerprints,
    history,
    landing,
    marts,
    neighbors,
    positions,
    profiling,
    quality,
    serving,
    similarity,
    staging,
)
from ..operators.history_store import HistoryStore
from ..operators.keyed import KeyedTable
from ..sources import mapping, raw
from ..sources.schemas import Rule
from ..session import materialize, scratch_dir
from ..streaming import incremental_stream, keyed_stream
from . import analogs, checks
from .analogs import ANALOG, NBITS, table, warehouse
from .oracles import QUERIES, tanimoto, words

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
NOW = "2024-06-01T00:00:00+00:00"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        REGISTRY[name] = run
        if sql:
            QUERIES[name] = sql
        return run

    return register


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles and join arrays to text, so results compare by value."""
    out = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            col = fn.round_fp(col, digits)
        elif isinstance(field.dataType, T.ArrayType):
            col = F.array_join(col.cast("array<string>"), ",")
        out.append(col.alias(field.name))
    return df.select(*out)


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp")


# --- landing ---------------------------------------------------------------------------


@query(
    "read_raw",
    "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders",
)
def read_raw(spark, sf):
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"
    return raw.read_raw(spark, sf, "orders", schema, "{entity}.parquet")


@query(
    "flatten_nested",
    """select o_orderkey, o_orderstatus as detail_status, o_totalprice as detail_price_amount,
              o_orderpriority as detail_price_priority from orders""",
)
def flatten_nested(spark, sf):
    price = F.struct(F.col("o_totalprice").alias("amount"), F.col("o_orderpriority").alias("priority"))
    nested = table(spark, sf, "orders").select(
        "o_orderkey", F.struct(F.col("o_orderstatus").alias("status"), price.alias("price")).alias("detail")
    )
    return raw.flatten_nested(nested, "_")


@query(
    "stringify_nested",
    """select conv_id, turn, to_json({'role': role, 'turn': turn})::varchar as detail,
              to_json([role, turn::varchar])::varchar as parts from conversations""",
)
def stringify_nested(spark, sf):
    nested = table(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        F.struct("role", "turn").alias("detail"),
        F.array("role", F.col("turn").cast("string")).alias("parts"),
    )
    return raw.stringify_nested(nested)


@query(
    "with_provenance",
    f"""select doc_id, lang, source, '{NOW}' as _fetch_ts, 'documents' as _source_endpoint, '36' as _chembl_version,
               sha256('doc_id=' || doc_id || chr(9) || 'lang=' || lang || chr(9) || 'source=' || source) as _row_hash
        from documents""",
)
def with_provenance(spark, sf):
    return raw.with_provenance(table(spark, sf, "documents").select("source", "doc_id", "lang"), "documents", "36", NOW)


@query(
    "row_hash",
    r"""select c_custkey, sha256('c_custkey=' || c_custkey || chr(9) || 'c_name=' || c_name || chr(9)
               || 'segment=' || coalesce(nullif(c_mktsegment, 'BUILDING'), '\N')) as row_hash from customer""",
)
def row_hash(spark, sf):
    df = table(spark, sf, "customer").select(
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"), "c_name", "c_custkey"
    )
    return df.select("c_custkey", raw.row_hash(df).alias("row_hash"))


@query(
    "enforce_schema",
    """select 'o_orderkey' as "column", 'type' as rule, 0::bigint as violations
       union all select 'o_orderkey', 'not_null', count(*) - count(o_orderkey) from orders
       union all select 'o_orderpriority', 'type', count(*) from orders where try_cast(o_orderpriority as double) is null
       union all select 'status', 'type', 0
       union all select 'status', 'not_null', count(*) from orders where o_orderstatus = 'P'""",
)
def enforce_schema(spark, sf):
    df = table(spark, sf, "orders").withColumn("status", F.nullif("o_orderstatus", F.lit("P")))
    rules = [Rule("o_orderkey", "bigint", False), Rule("o_orderpriority", "double"), Rule("status", "string", False)]
    return raw.schema_violations(df, rules)


@query("write_entity", "select * from customer")
def write_entity(spark, sf):
    customers = table(spark, sf, "customer")
    folder = scratch_dir(spark, "landing")
    raw.write_entity(customers, folder, "customer")
    return raw.read_raw(spark, folder, "customer", customers.schema)


@query("derive_ids", "select distinct molecule_chembl_id from raw_activities where molecule_chembl_id <> ''")
def derive_ids(spark, sf):
    return landing.derive_ids(analogs.activities(spark, sf), "molecule_chembl_id")


@query(
    "scope_filter",
    """select activity_id, molecule_chembl_id, target_chembl_id, standard_type, pchembl_value from raw_activities
       where standard_type in ('IC50', 'Ki') and pchembl_value is not null and standard_relation = '='
         and target_chembl_id in (select target_chembl_id from stg_targets)""",
)
def scope_filter(spark, sf):
    return landing.scope_filter(
        analogs.activities(spark, sf),
        in_lists={"standard_type": ["IC50", "Ki"], "target_chembl_id": warehouse(spark, sf).stg_targets},
        equals={"standard_relation": "="},
        not_null=["pchembl_value"],
    ).select("activity_id", "molecule_chembl_id", "target_chembl_id", "standard_type", "pchembl_value")


@query(
    "stamp_lookup",
    """select event_id, event_type, case event_type when 'view' then 'topo1_inhibitor' when 'click' then 'tubulin_inhibitor' end
              as payload_class, case event_type when 'view' then 'Viewer' when 'click' then 'Clicker' end as reference_name
       from events""",
)
def stamp_lookup(spark, sf):
    rows = [("view", "topo1_inhibitor", "Viewer"), ("click", "tubulin_inhibitor", "Clicker")]
    lookup = spark.createDataFrame(rows, "event_type string, payload_class string, reference_name string")
    events = table(spark, sf, "events").select("event_id", "event_type")
    return landing.stamp_lookup(events, "event_type", lookup, ["payload_class", "reference_name"])


@query(
    "read_bulk_mapping",
    """select 'M' || doc_id as molecule_chembl_id, s.source, lang || n_chars as xref_id
       from documents, (select unnest(['pdbe', 'pubchem']) as source) s where doc_id in (select p_partkey from part)""",
)
def read_bulk_mapping(spark, sf):
    folder = scratch_dir(spark, "dumps")
    rows = table(spark, sf, "documents").select(
        F.concat(F.lit("M"), F.col("doc_id").cast("string")).alias("from_id"),
        F.concat("lang", F.col("n_chars").cast("string")).alias("to_id"),
    )
    files = {name: f"src1src{n}.txt.gz" for name, n in (("pdbe", 5), ("pubchem", 22))}
    for file in files.values():
        rows.write.csv(f"{folder}/{file}", sep="\t", header=True, compression="gzip")
    files["drugbank"] = "src1src2.txt.gz"  # not delivered
    return mapping.read_bulk_mapping(spark, folder, files, analogs.molecules(spark, sf))


@query(
    "reference_codes",
    """select distinct molecule_chembl_id, xref_id as ligand_code from stg_xref where source = 'pdbe'
       union select molecule_chembl_id, xref_id from stg_unichem where source = 'pdbe'""",
)
def reference_codes(spark, sf):
    return landing.reference_codes(analogs.molecules(spark, sf), analogs.xref_unichem(spark, sf), "pdbe")


@query(
    "resolve_capped",
    """select ligand_code, pdb_id from (
         select *, row_number() over (partition by ligand_code order by pdb_id) as rn
         from (select distinct 'L' || user_id as ligand_code, unnest(['p' || event_id, 'q' || (event_id // 2)]) as pdb_id
               from events)) where rn <= 50""",
)
def resolve_capped(spark, sf):
    event = F.col("event_id").cast("string")
    half = F.floor(F.col("event_id") / 2).cast("string")
    payload = F.concat(F.lit('[{"pdb_id":"P'), event, F.lit('","kind":"x"},"Q'), half, F.lit('","",{"kind":"y"}]'))
    responses = table(spark, sf, "events").select(
        F.concat(F.lit("L"), F.col("user_id").cast("string")).alias("code"), payload.alias("payload")
    )
    return landing.resolve_capped(responses, "code", "payload")


@query(
    "merge_entry_metadata",
    """select 'p' || event_id as pdb_id, case when o_orderstatus <> 'P' then 'Entry ' || o_orderkey end as title,
              case when o_orderstatus <> 'F' then o_orderpriority end as method, year(o_orderdate)::varchar as year,
              case when o_totalprice > 100000 then o_totalprice end as resolution
       from events left join orders on o_orderkey = event_id""",
)
def merge_entry_metadata(spark, sf):
    orders = table(spark, sf, "orders").withColumn("pdb_id", F.concat(F.lit("P"), F.col("o_orderkey").cast("string")))
    ids = table(spark, sf, "events").select(F.concat(F.lit("P"), F.col("event_id").cast("string")).alias("pdb_id"))
    methods = F.when(F.col("o_orderstatus") == "F", F.array().cast("array<string>")).otherwise(
        F.array("o_orderpriority", F.lit("second"))
    )
    title = F.when(F.col("o_orderstatus") == "P", F.lit("  ")).otherwise(
        F.concat(F.lit(" Entry "), F.col("o_orderkey").cast("string"), F.lit(" "))
    )
    summary = orders.select(
        "pdb_id",
        title.alias("title"),
        methods.alias("experimental_method"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("release_date"),
    )
    experiment = orders.where("o_totalprice > 100000").select("pdb_id", F.col("o_totalprice").alias("resolution"))
    return landing.merge_entry_metadata(ids, summary, experiment)


_BITS = f"list_sort(list_distinct(list_transform({words('text')}, lambda w: (('0x' || md5(w)[1:4])::bigint % 2048)::int)))"
_HEX = (
    "array_to_string(list_transform(range({n}), lambda i: format('{{:x}}', list_sum(list_transform([0, 1, 2, 3],"
    " lambda k: case when list_contains({bits}, (4 * i + k)::int) then (8 >> k::int) else 0 end))::int)), '')"
)


@query(
    "hashed_fingerprint",
    f"""select doc_id, array_to_string(bits, ',') as onbits, len(bits)::int as n_onbits,
               {_HEX.format(n=512, bits="bits")} as hex, sha256(doc_id || chr(9) || array_to_string(words, ' ')) as _row_hash,
               '{NOW}' as _fetch_ts, 'hashed' as _source, '1' as _version
        from (select doc_id, {words('text')} as words, {_BITS} as bits from documents) where len(words) > 0""",
)
def hashed_fingerprint(spark, sf):
    docs = analogs.documents(spark, sf)
    return tidy(fingerprints.hashed_fingerprint(docs, "doc_id", fn.word_set("text"), 2048, now=NOW))


@query(
    "fingerprint_dropped",
    f"""select count(*) filter (where n > 0) as computed, count(*) filter (where n = 0) as skipped
        from (select len({words('text')}) as n from documents)""",
)
def fingerprint_dropped(spark, sf):
    return fingerprints.count_dropped(table(spark, sf, "documents"), fn.word_set("text"))


def _leading(name: str, start: str, squarings: int = 14) -> str:
    """CTEs for the leading eigenvector (i, e) of the matrix ``start`` (i, j, v), by squaring it again and again."""
    steps = [f"{name}0 as materialized (select i, j, v / max(abs(v)) over () as v from {start})"]
    for k in range(1, squarings + 1):
        square = f"select a.i, b.j, sum(a.v * b.v) as v from {name}{k - 1} a join {name}{k - 1} b on a.j = b.i group by all"
        steps.append(f"{name}{k} as materialized (select i, j, v / max(abs(v)) over () as v from ({square}))")
    last = f"{name}{squarings}"
    steps.append(
        f"{name}_u as (select i, v / sqrt(sum(v * v) over ()) as e from {last}"
        f" where j = (select j from {last} where i = j order by v desc, j limit 1))"
    )
    steps.append(f"{name} as materialized (select i, e * (select sign(e) from {name}_u order by abs(e) desc, i limit 1) as e from {name}_u)")
    return ",\n".join(steps)


@query(
    "project_2d",
    f"""with v as (select vec_id, unnest(embedding)::double as x, generate_subscripts(embedding, 1) as i
                  from embeddings where embedding is not null),
        c as materialized (select vec_id, i, x - avg(x) over (partition by i) as x from v),
        s as materialized (select a.i, b.i as j, sum(a.x * b.x) as v from c a join c b using (vec_id) group by all),
        {_leading("p", "s")},
        l as (select sum(a.e * s.v * b.e) as l from s join p a on a.i = s.i join p b on b.i = s.j),
        d as materialized (select s.i, s.j, s.v - l.l * a.e * b.e as v from s join p a on a.i = s.i join p b on b.i = s.j, l),
        {_leading("q", "d")}
        select vec_id, round(sum(c.x * p.e), 4) as x, round(sum(c.x * q.e), 4) as y
        from c join p using (i) join q using (i) group by vec_id""",
)
def project_2d(spark, sf):
    return tidy(fingerprints.project_2d(table(spark, sf, "embeddings"), "vec_id", "embedding"), 4)


@query(
    "project_2d_invariants",
    """select count(*) as n, true as centred, true as uncorrelated, true as ordered, true as within_total
       from embeddings where embedding is not null""",
)
def project_2d_invariants(spark, sf):
    """What holds for principal components, whatever signs they take, over the whole table."""
    vectors = table(spark, sf, "embeddings")
    total = vectors.select(F.posexplode("embedding").alias("i", "v")).groupBy("i").agg(F.var_samp("v").alias("s"))
    total = total.agg(F.sum("s")).first()[0]
    points = fingerprints.project_2d(vectors, "vec_id", "embedding").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(f"mean_{c}") for c in "xy"],
        *[F.var_samp(c).alias(f"var_{c}") for c in "xy"],
        F.covar_samp("x", "y").alias("both"),
    )
    near = 1e-9 * total
    return points.select(
        "n",
        (F.abs("mean_x") + F.abs("mean_y") < 1e-6).alias("centred"),
        (F.abs("both") < F.greatest(F.lit(near), F.lit(1e-9))).alias("uncorrelated"),
        (F.col("var_x") >= F.col("var_y")).alias("ordered"),
        (F.col("var_x") + F.col("var_y") <= total + near).alias("within_total"),
    )


_SIGNED = (
    "(('0x' || {h})::ubigint::hugeint - case when ('0x' || {h})::ubigint >= 9223372036854775808::ubigint"
    " then 18446744073709551616::hugeint else 0::hugeint end)::bigint"
)


@query(
    "fingerprint_pack",
    f"""select vec_id, hex as ecfp4_hex, {_SIGNED.format(h="hex")}::varchar as words, array_to_string(bits, ',') as onbits,
               len(bits)::int as n_onbits
        from (select vec_id, bits, {_HEX.format(n=16, bits="bits")} as hex
              from (select vec_id, list_filter(list_transform(range(64), lambda i: case when embedding[i + 1] > 0 then i::int end),
                                               lambda x: x is not null) as bits from embeddings))""",
)
def fingerprint_pack(spark, sf):
    vectors = table(spark, sf, "embeddings").select(
        "vec_id", fn.bits_to_hex(fingerprints.set_bits("embedding"), NBITS).alias("ecfp4_hex")
    )
    return tidy(fingerprints.fingerprint_pack(vectors, "ecfp4_hex", NBITS))


# --- staging ---------------------------------------------------------------------------


@query("stage_activities", "select * replace (round(pchembl_value, 6) as pchembl_value) from stg_activities")
def stage_activities(spark, sf):
    return tidy(warehouse(spark, sf).stg_activities)


@query(
    "dedupe",
    """select * exclude (rn) from (
         select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate::varchar as l_shipdate,
                row_number() over (partition by l_orderkey, l_linenumber
                                   order by l_partkey, l_suppkey, l_extendedprice, l_shipdate) as rn
         from lineitem) where rn = 1""",
)
def dedupe(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"
    )
    kept = staging.dedupe(lines, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"])
    return kept.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))


_R_MOL = "* replace (round(mw_freebase, 6) as mw_freebase, round(alogp, 6) as alogp, round(psa, 6) as psa, round(qed_weighted, 6) as qed_weighted)"


@query("stage_molecules", f"select {_R_MOL} from stg_molecules")
def stage_molecules(spark, sf):
    return tidy(warehouse(spark, sf).stg_molecules)


@query("stage_targets", "select * from stg_targets")
def stage_targets(spark, sf):
    return warehouse(spark, sf).stg_targets


@query("stage_assays", "select * from stg_assays")
def stage_assays(spark, sf):
    return warehouse(spark, sf).stg_assays


@query("stage_cell_activities", "select * replace (round(p_cyto, 6) as p_cyto) from stg_cell")
def stage_cell_activities(spark, sf):
    return tidy(warehouse(spark, sf).stg_cell_activities)


@query(
    "stage_cheminfo",
    f"""select molecule_chembl_id, canonical_smiles, {_HEX.format(n=16, bits="ecfp4_onbits")} as ecfp4_hex,
               array_to_string(ecfp4_onbits, ',') as ecfp4_onbits, len(ecfp4_onbits)::int as n_onbits, heavy_atom_count,
               murcko_scaffold_smiles, murcko_generic_smiles from raw_cheminfo""",
)
def stage_cheminfo(spark, sf):
    return tidy(warehouse(spark, sf).stg_compound_cheminfo)


@query(
    "stage_embedding",
    """select 'M' || vec_id as molecule_chembl_id, round(embedding[1]::double, 4) as umap_x,
              round(embedding[2]::double, 4) as umap_y from embeddings""",
)
def stage_embedding(spark, sf):
    return tidy(warehouse(spark, sf).stg_compound_embedding)


@query(
    "explode_json_refs",
    """select event_id, 'pdbe' as source, 'E' || event_id as xref_id, event_type as xref_name from events where event_id % 5 = 4
       union all select event_id, 'zinc', 'Z' || event_id, null from events where event_id % 5 = 4""",
)
def explode_json_refs(spark, sf):
    event = F.col("event_id")
    text = event.cast("string")
    array = F.concat(
        F.lit(' [{"xref_src":"PDBe","xref_id":"E'),
        text,
        F.lit('","xref_name":"'),
        F.col("event_type"),
        F.lit('"},{"xref_src":"ZINC","xref_id":"Z'),
        text,
        F.lit('"},{"xref_src":"EMA"}]'),
    )
    json = (
        F.when(event % 5 == 0, F.lit(None).cast("string"))
        .when(event % 5 == 1, "null")
        .when(event % 5 == 2, "[]")
        .when(event % 5 == 3, '{"xref_src":"PDBe","xref_id":"x"}')
        .otherwise(array)
    )
    return staging.explode_json_refs(table(spark, sf, "events").withColumn("refs", json), "event_id", "refs")


@query("stage_mapping", "select * from stg_unichem")
def stage_mapping(spark, sf):
    return warehouse(spark, sf).stg_compound_xref_unichem


@query("rename_key", "select * from stg_structure")
def rename_key(spark, sf):
    return warehouse(spark, sf).stg_pdbe_structure


@query("stage_entry_summary", "select * replace (round(resolution, 6) as resolution) from stg_summary")
def stage_entry_summary(spark, sf):
    return tidy(warehouse(spark, sf).stg_pdbe_summary)


# --- star schema and history -------------------------------------------------------------


@query("dense_key", "select row_number() over (order by o_orderkey) as order_no, o_orderkey, o_custkey from orders")
def dense_key(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return positions.dense_key(orders, "o_orderkey", "order_no", ranges=8)


@query("dim_compound", f"select {_R_MOL} from dim_compound")
def dim_compound(spark, sf):
    return tidy(dims.dim_compound(warehouse(spark, sf).stg_molecules, ranges=4))


@query("dim_target", "select * from dim_target")
def dim_target(spark, sf):
    return warehouse(spark, sf).dim_target


@query("dim_assay", "select * from dim_assay")
def dim_assay(spark, sf):
    return dims.dim_assay(warehouse(spark, sf).stg_assays, ranges=8)


@query("dim_scaffold", "select * from dim_scaffold")
def dim_scaffold(spark, sf):
    return warehouse(spark, sf).dim_scaffold


@query("fact_star", "select * replace (round(pchembl_value, 6) as pchembl_value) from fact")
def fact_star(spark, sf):
    return tidy(warehouse(spark, sf).fact_star)


def _releases(spark, sf) -> tuple[DataFrame, DataFrame]:
    """First release: the events of the earliest 80% of the time span; second: all of them."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    last = events.agg(F.max("event_id")).first()[0]
    return events.where(F.col("event_id") < F.lit(0.8 * last)), events


@query("incremental_append", "select event_id, user_id, event_type, value from events")
def incremental_append(spark, sf):
    first, everything = _releases(spark, sf)
    # A re-emitted id is not refreshed by an append: the changed values must not show up.
    changed = everything.withColumn("value", F.when(F.col("event_id").isin(0, 1), -1.0).otherwise(F.col("value")))
    return history.incremental_append(history.incremental_append(first, changed, "event_id"), changed, "event_id")


@query(
    "incremental_upsert",
    "select event_id, user_id, event_type, case when event_type = 'click' then value + 1 else value end as value from events",
)
def incremental_upsert(spark, sf):
    _, everything = _releases(spark, sf)
    batch = everything.where("event_type = 'click'").withColumn("value", F.col("value") + 1.0)
    return history.incremental_upsert(everything, batch, "event_id")


@query("incremental_stream", "select event_id, user_id, event_type, value from events")
def incremental_stream_query(spark, sf):
    folder = scratch_dir(spark, "stream")
    first, everything = _releases(spark, sf)
    first.write.parquet(f"{folder}/in")
    schema = everything.schema
    args = (spark, f"{folder}/in", schema, f"{folder}/out", f"{folder}/checkpoint", "event_id")
    incremental_stream(*args).awaitTermination()
    everything.write.mode("append").parquet(f"{folder}/in")
    incremental_stream(*args).awaitTermination()
    return spark.read.parquet(f"{folder}/out").drop("_batch")


def _shuffled_releases(spark, sf) -> tuple[DataFrame, DataFrame]:
    """First release: four events of five, of any age; second: all of them, with changed values of two old ones."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    changed = events.withColumn("value", F.when(F.col("event_id").isin(1, 2), -1.0).otherwise(F.col("value")))
    return events.where(F.col("event_id") % 5 != 0), changed


@query("keyed_append", "select event_id, user_id, event_type, value from events")
def keyed_append(spark, sf):
    loaded = KeyedTable(spark, scratch_dir(spark, "keyed"), "event_id", buckets=16)
    first, second = _shuffled_releases(spark, sf)
    for batch in (first, second, second):
        loaded.append(batch)
    return loaded.read()


@query(
    "keyed_upsert",
    "select event_id, user_id, event_type, case when event_type = 'click' then value + 1 else value end as value from events",
)
def keyed_upsert(spark, sf):
    loaded = KeyedTable(spark, scratch_dir(spark, "keyed"), "event_id", buckets=16)
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    loaded.append(events)
    loaded.upsert(events.where("event_type = 'click'").withColumn("value", F.col("value") + 1.0))
    return loaded.read()


@query("keyed_stream", "select event_id, user_id, event_type, value from events")
def keyed_stream_query(spark, sf):
    folder = scratch_dir(spark, "stream")
    loaded = KeyedTable(spark, f"{folder}/out", "event_id", buckets=16)
    for batch in _shuffled_releases(spark, sf):
        batch.write.mode("append").parquet(f"{folder}/in")
        keyed_stream(spark, f"{folder}/in", batch.schema, loaded, f"{folder}/checkpoint").awaitTermination()
    return loaded.read()


def _customer_releases(spark, sf) -> tuple[DataFrame, DataFrame]:
    customers = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    key, balance = F.col("c_custkey"), F.col("c_acctbal")
    raised = F.when(key % 10 == 0, F.lit(100.0)).otherwise(F.lit(0.0))
    changed = customers.where(key % 97 != 0).withColumn("c_acctbal", balance + raised)
    added = customers.where(key % 50 == 0).withColumn("c_custkey", key + 1000000)
    return customers, changed.unionByName(added)


def _history(spark, sf) -> DataFrame:
    customers, changed = _customer_releases(spark, sf)
    loaded = history.scd2_initial(customers, "c_custkey", _ts("2024-01-01"))
    return history.scd2_apply(loaded, changed, "c_custkey", ["c_acctbal", "c_mktsegment"], _ts("2024-06-01"))


def _dated(df: DataFrame) -> DataFrame:
    text = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("valid_from", "valid_to")}
    return tidy(df.withColumns(text).drop("window_id"))


_R_SCD = """select c_custkey, round(c_acctbal, 6) as c_acctbal, c_mktsegment,
                   strftime(valid_from, '%Y-%m-%d %H:%M:%S') as valid_from,
                   strftime(valid_to, '%Y-%m-%d %H:%M:%S') as valid_to from scd_history"""


@query("scd2_apply", _R_SCD)
def scd2_apply(spark, sf):
    return _dated(_history(spark, sf))


@query("history_store", _R_SCD)
def history_store(spark, sf):
    store = HistoryStore(spark, scratch_dir(spark, "history"), "c_custkey", ["c_acctbal", "c_mktsegment"])
    customers, changed = _customer_releases(spark, sf)
    store.apply(customers, _ts("2024-01-01"))
    store.compact()
    for month in (6, 7):  # the second time nothing has changed
        store.apply(changed, _ts(f"2024-0{month}-01"))
    return _dated(store.read())


@query(
    "scd2_as_of",
    _R_SCD + " where valid_from <= timestamp '2024-03-01' and (valid_to is null or valid_to > timestamp '2024-03-01')",
)
def scd2_as_of(spark, sf):
    return _dated(history.scd2_as_of(_history(spark, sf), _ts("2024-03-01")))


# --- marts -------------------------------------------------------------------------------

_R_SAR = "* replace (round(median_pchembl, 6) as median_pchembl, round(max_pchembl, 6) as max_pchembl)"


@query("target_sar", f"select {_R_SAR} from sar")
def target_sar(spark, sf):
    return tidy(warehouse(spark, sf).mart_target_sar)


_R_SEL = (
    "* replace (round(best_pchembl, 6) as best_pchembl, round(second_best_pchembl, 6) as second_best_pchembl,"
    " round(selectivity_index, 6) as selectivity_index, round(pchembl_spread, 6) as pchembl_spread)"
)


@query("selectivity", f"select {_R_SEL} from sel")
def selectivity(spark, sf):
    return tidy(warehouse(spark, sf).mart_compound_selectivity)


@query(
    "chemical_space",
    """select c.compound_key, c.molecule_chembl_id, pref_name, round(mw_freebase, 6) as mw_freebase, round(alogp, 6) as alogp,
              hba, hbd, round(psa, 6) as psa, rotatable_bonds, num_ro5_violations, aromatic_rings,
              round(qed_weighted, 6) as qed_weighted, is_approved_drug, round(s.best_pchembl, 6) as best_pchembl,
              coalesce(s.n_targets, 0) as n_targets, best_target, murcko_scaffold_smiles,
              round(embedding[1]::double, 4) as umap_x, round(embedding[2]::double, 4) as umap_y
       from dim_compound c left join sel s using (compound_key) left join fp using (compound_key)
            left join embeddings on c.molecule_chembl_id = 'M' || vec_id""",
)
def chemical_space(spark, sf):
    return tidy(warehouse(spark, sf).mart_chemical_space)


@query(
    "fingerprint_mart",
    f"""select compound_key, molecule_chembl_id, {_HEX.format(n=16, bits="ecfp4_onbits")} as ecfp4_hex,
               array_to_string(ecfp4_onbits, ',') as ecfp4_onbits, n_onbits::int as n_onbits, heavy_atom_count,
               murcko_scaffold_smiles, scaffold_key from fp""",
)
def fingerprint_mart(spark, sf):
    return tidy(warehouse(spark, sf).mart_compound_fingerprint)


@query("chemical_series", "select * from series")
def chemical_series(spark, sf):
    return warehouse(spark, sf).mart_chemical_series


@query("activity_cliff", "select * from cliff")
def activity_cliff(spark, sf):
    return warehouse(spark, sf).mart_activity_cliff


def _document_pairs(spark, sf, threshold: float = 0.75, delta: float = 1.0) -> DataFrame:
    docs = analogs.document_sets(spark, sf)
    members = docs.where(F.size("words") > 0).select(
        "lang", "doc_id", "potency", similarity.set_class("words").alias("cls")
    )
    members = materialize(members, "members")  # the sets would be computed anew for every use
    pairs = similarity.group_pairs(docs, "words", threshold, members, "lang", "potency", delta)
    return similarity.cliffs_of_pairs(members, pairs, "lang", "doc_id", "potency", delta)


@query(
    "activity_cliff_sets",
    """select lang, ida, idb, delta, round(t, 3) as tanimoto, t >= 1 as is_identical_fp,
              case when t < 1 then round(delta / (1 - t), 2) end as sali
       from doc_scored where t >= 0.75 and delta >= 1""",
)
def activity_cliff_sets(spark, sf):
    """Cliffs over word sets of whole documents, with near and exact copies."""
    t = F.col("similarity")
    return _document_pairs(spark, sf).select(
        "lang",
        F.col("a.doc_id").alias("ida"),
        F.col("b.doc_id").alias("idb"),
        "delta",
        fn.round_fp(t, 3).alias("tanimoto"),
        (t >= 1.0).alias("is_identical_fp"),
        F.when(t < 1.0, fn.round_fp(F.col("delta") / (1.0 - t), 2)).alias("sali"),
    )


@query("compound_xref", "select * from xref")
def compound_xref(spark, sf):
    return warehouse(spark, sf).mart_compound_xref


@query("compound_pdb", "select * replace (round(resolution, 6) as resolution) from pdb")
def compound_pdb(spark, sf):
    return tidy(warehouse(spark, sf).mart_compound_pdb)


_R_CAT = (
    _R_MOL[:-1]
    + ", round(best_pchembl, 6) as best_pchembl, round(selectivity_index, 6) as selectivity_index)"
)


@query("compound_catalog", f"select {_R_CAT} from catalog")
def compound_catalog(spark, sf):
    return tidy(warehouse(spark, sf).mart_compound_catalog)


@query(
    "class_profile",
    """select payload_class, count(distinct compound_key) as n_compounds, sum(n_measurements)::bigint as n_measurements,
              round(median(median_pchembl), 3) as median_pchembl, round(max(max_pchembl), 3) as max_pchembl,
              round(quantile_cont(median_pchembl, 0.25), 3) as p25_pchembl,
              round(quantile_cont(median_pchembl, 0.75), 3) as p75_pchembl,
              count(distinct case when max_pchembl >= 9 then compound_key end) as n_sub_nanomolar
       from sar where payload_class is not null group by 1""",
)
def class_profile(spark, sf):
    return warehouse(spark, sf).mart_payload_class_profile


@query("cytotoxicity", "select * from cyto")
def cytotoxicity(spark, sf):
    return warehouse(spark, sf).mart_compound_cytotoxicity


# --- serving -----------------------------------------------------------------------------


@query(
    "scaffold_members",
    """select f.scaffold_key, f.molecule_chembl_id, c.pref_name, c.canonical_smiles, round(best_pchembl, 2) as best_pchembl,
              coalesce(n_targets, 0) as n_targets
       from fp f join dim_compound c using (compound_key) left join potency using (compound_key)
       where f.scaffold_key is not null""",
)
def scaffold_members(spark, sf):
    w = warehouse(spark, sf)
    return serving.scaffold_members(
        w.mart_compound_fingerprint, w.dim_compound, w.mart_target_sar, w.dim_scaffold.select("scaffold_key")
    )


_CAT_NULLS = """null::bigint as n_targets, null::double as best_pchembl, null::varchar as best_target,
    null::varchar as payload_class, null::double as selectivity_index, null::bigint as n_pdb_entries, null::boolean as has_pdb"""


@query(
    "compound_row",
    f"""select {_R_CAT} from (select * from catalog union all
        select *, {_CAT_NULLS} from dim_compound where compound_key not in (select compound_key from catalog))""",
)
def compound_row(spark, sf):
    w = warehouse(spark, sf)
    everyone = analogs.molecules(spark, sf).select("molecule_chembl_id")
    return tidy(serving.compound_row(w.mart_compound_catalog, w.dim_compound, everyone))


@query(
    "target_profile",
    """select compound_key, target_pref_name as target, round(median_pchembl, 2) as median_pchembl,
              round(max_pchembl, 2) as max_pchembl, n_measurements, n_assays from sar""",
)
def target_profile(spark, sf):
    w = warehouse(spark, sf)
    return serving.target_profile(w.mart_target_sar, w.dim_compound.select("compound_key"))


@query(
    "xref_summary",
    """select compound_key, display_name, min(xref_id) as xref_id, min({x: xref_id, u: url}).u as url, count(*) as n_refs
       from xref group by 1, 2""",
)
def xref_summary(spark, sf):
    w = warehouse(spark, sf)
    return serving.xref_summary(w.mart_compound_xref, w.dim_compound.select("compound_key"))


@query(
    "pdb_entries",
    "select distinct compound_key, ligand_code, pdb_id, title, method, year, round(resolution, 6) as resolution from pdb",
)
def pdb_entries(spark, sf):
    w = warehouse(spark, sf)
    return tidy(serving.pdb_entries(w.mart_compound_pdb, w.dim_compound.select("compound_key")))


@query("target_names", "select pref_name from dim_target order by 1")
def target_names(spark, sf):
    return serving.target_names(warehouse(spark, sf).dim_target)


@query(
    "target_summary",
    """select t.pref_name as target, target_type, count(distinct compound_key) as n_compounds, count(*) as n_pairs,
              round(median(median_pchembl), 2) as median_pchembl, round(max(max_pchembl), 2) as best_pchembl
       from sar join dim_target t using (target_key) group by 1, 2""",
)
def target_summary(spark, sf):
    w = warehouse(spark, sf)
    return serving.target_summary(w.mart_target_sar, w.dim_target)


@query(
    "confidence_distribution",
    """select confidence_score, count(*) as n_activities, count(distinct assay_key) as n_assays
       from fact join dim_assay using (assay_key) group by 1""",
)
def confidence_distribution(spark, sf):
    w = warehouse(spark, sf)
    return serving.confidence_distribution(w.fact_activity, w.stg_assays)


@query(
    "type_distribution",
    "select standard_type, count(*) as n_activities, count(distinct compound_key) as n_compounds from fact group by 1",
)
def type_distribution(spark, sf):
    return serving.type_distribution(warehouse(spark, sf).fact_activity)


@query(
    "layer_counts",
    """select 'stg_activities' as "table", count(*) as rows from stg_activities union all
       select 'dim_compound', count(*) from dim_compound union all select 'fact_activity', count(*) from fact union all
       select 'orders', count(*) from orders""",
)
def layer_counts(spark, sf):
    w = warehouse(spark, sf)
    tables = {
        "stg_activities": w.stg_activities,
        "dim_compound": w.stg_molecules,
        "fact_activity": w.fact_activity,
        "orders": f"{sf}/orders.parquet",
        "absent": f"{sf}/absent.parquet",
    }
    return serving.layer_counts(spark, tables)


@query(
    "headline_metrics",
    """select 'compounds' as metric, count(*) as value from dim_compound union all
       select 'approved', count(*) from dim_compound where is_approved_drug union all
       select 'activities', count(*) from fact union all select 'targets', count(*) from dim_target""",
)
def headline_metrics(spark, sf):
    w = warehouse(spark, sf)
    return serving.headline_metrics(w.stg_molecules, w.fact_activity, w.stg_targets)


_SCOPE = serving.Scope(
    targets=("NATION_0", "NATION_1", "NATION_2", "NATION_6", "NATION_13"), approval="research", min_pchembl=4.5, structure_only=True
)
_SCOPE_SQL = """select distinct compound_key from catalog join (select compound_key from sar where target_pref_name in
    ('NATION_0', 'NATION_1', 'NATION_2', 'NATION_6', 'NATION_13')) using (compound_key)
    where not is_approved_drug and best_pchembl >= 4.5 and has_pdb"""
_SCOPED_SQL = f"""select * from sar where compound_key in ({_SCOPE_SQL})
    and target_pref_name in ('NATION_0', 'NATION_1', 'NATION_2', 'NATION_6', 'NATION_13')"""


@query("resolve_scope", _SCOPE_SQL)
def resolve_scope(spark, sf):
    w = warehouse(spark, sf)
    return serving.resolve_scope(w.mart_target_sar, w.mart_compound_catalog, _SCOPE)


@query("scoped_sar", f"select {_R_SAR} from ({_SCOPED_SQL})")
def scoped_sar(spark, sf):
    w = warehouse(spark, sf)
    keys = serving.resolve_scope(w.mart_target_sar, w.mart_compound_catalog, _SCOPE)
    return tidy(serving.scoped_sar(w.mart_target_sar, _SCOPE, keys))


@query(
    "overview_metrics",
    f"""select 'compounds' as metric, count(*) as value from ({_SCOPE_SQL})
        union all select 'activities', coalesce(sum(n_measurements), 0)::bigint from ({_SCOPED_SQL})
        union all select 'targets', count(distinct target_pref_name) from ({_SCOPED_SQL})
        union all select 'pairs', count(*) from ({_SCOPED_SQL})
        union all select 'multi_target', count(*) from catalog where n_targets >= 2 and compound_key in ({_SCOPE_SQL})
        union all select 'approved', count(*) from catalog where is_approved_drug and compound_key in ({_SCOPE_SQL})""",
)
def overview_metrics(spark, sf):
    w = warehouse(spark, sf)
    return serving.overview_metrics(w.mart_target_sar, w.mart_compound_catalog, _SCOPE)


@query(
    "ro5_breakdown",
    """select molecule_chembl_id, mw_freebase <= 500 as mw_ok, alogp <= 5 as logp_ok, hbd <= 5 as hbd_ok, n <= 10 as hba_ok,
              (coalesce((mw_freebase > 500)::int, 0) + coalesce((hbd > 5)::int, 0) + coalesce((alogp > 5)::int, 0)
               + coalesce((n > 10)::int, 0))::int as violations
       from (select molecule_chembl_id, mw_freebase, hbd, nullif(alogp, 0) as alogp, nullif(hba, 3) as n from stg_molecules)""",
)
def ro5_breakdown(spark, sf):
    compounds = warehouse(spark, sf).stg_molecules.select(
        "molecule_chembl_id", "mw_freebase", "hbd", F.nullif("alogp", F.lit(0.0)).alias("alogp"), F.nullif("hba", F.lit(3)).alias("hba")
    )
    flags = ["mw_ok", "logp_ok", "hbd_ok", "hba_ok", "violations"]
    return serving.ro5_breakdown(compounds).select("molecule_chembl_id", *flags)


@query(
    "efficiency",
    """select molecule_chembl_id, round(case when ro5 <> 0 then 1.37::double * mw / ro5 end, 6) as ligand_efficiency,
              round(mw - alogp, 6) as lipophilic_efficiency from raw_molecules""",
)
def efficiency(spark, sf):
    scored = serving.efficiency(warehouse(spark, sf).stg_molecules, "mw_freebase", "num_ro5_violations", "alogp")
    return tidy(scored.select("molecule_chembl_id", "ligand_efficiency", "lipophilic_efficiency"))


@query(
    "score_pairs",
    f"""with v as (select vec_id, list_filter(list_transform(range(64), lambda i: case when embedding[i + 1] > 0 then i end),
                                              lambda x: x is not null) as bits from embeddings)
        select l_orderkey, l_linenumber, l_partkey as vec_id_a, l_suppkey as vec_id_b,
               round(case when a.bits is null or b.bits is null then 0 else {tanimoto("a.bits", "b.bits")} end, 6) as tanimoto
        from lineitem left join v a on a.vec_id = l_partkey left join v b on b.vec_id = l_suppkey""",
)
def score_pairs(spark, sf):
    pairs = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("vec_id_a"), F.col("l_suppkey").alias("vec_id_b")
    )
    vectors = table(spark, sf, "embeddings").select(
        "vec_id", fn.bits_to_hex(fingerprints.set_bits("embedding"), NBITS).alias("hex")
    )
    return tidy(serving.score_pairs(pairs, vectors, "vec_id", "hex", NBITS))


@query(
    "nearest_neighbors",
    f"""select molecule_chembl_id, pref_name, round(t, 3) as tanimoto, round(best_pchembl, 6) as best_pchembl,
               round(best_pchembl - q_best, 2) as delta_pchembl, best_target
        from (select b.compound_key, b.molecule_chembl_id, {tanimoto("a.ecfp4_onbits", "b.ecfp4_onbits")} as t,
                     (select best_pchembl from catalog where compound_key = 1) as q_best
              from fp a, fp b where a.compound_key = 1 and b.compound_key <> 1)
             left join (select compound_key, pref_name, best_pchembl, best_target from catalog) using (compound_key)
        where t >= 0.2 order by t desc, molecule_chembl_id limit 10""",
)
def nearest_neighbors(spark, sf):
    w = warehouse(spark, sf)
    found = serving.nearest_neighbors(
        1, w.mart_compound_fingerprint, w.mart_compound_catalog, k=10, min_similarity=0.2, nbits=NBITS
    )
    return tidy(found)


@query("nearest_neighbors_indexed", QUERIES["nearest_neighbors"])
def nearest_neighbors_indexed(spark, sf):
    w = warehouse(spark, sf)
    prints = w.mart_compound_fingerprint
    index = neighbors.write_popcount_index(prints, scratch_dir(spark, "popcount"), nbits=NBITS)
    return tidy(serving.nearest_neighbors(1, prints, w.mart_compound_catalog, 10, 0.2, nbits=NBITS, index=index))


@query(
    "nearest_neighbors_all",
    """with pairs as (
         select ida, idb, shared::double / (na + nb - shared) as t
         from (select a.doc_id as ida, b.doc_id as idb, a.n as na, b.n as nb, len(list_intersect(a.codes, b.codes)) as shared
               from doc_codes a join doc_codes b on a.doc_id < b.doc_id
                    and least(a.n, b.n) >= 0.7 * greatest(a.n, b.n) - 1e-6)
         where t >= 0.7),
       ranked as (select doc_id, neighbor, t, row_number() over (partition by doc_id order by t desc, neighbor)::int as rank
                  from (select ida as doc_id, idb as neighbor, t from pairs union all select idb, ida, t from pairs))
       select doc_id, neighbor, round(t, 6) as similarity, rank from ranked where rank <= 3""",
)
def nearest_neighbors_all(spark, sf):
    docs = analogs.document_sets(spark, sf)
    return tidy(similarity.nearest_neighbors_all(docs, "doc_id", "words", 3, 0.7))


@query(
    "filter_cliffs",
    """select * from cliff where tanimoto >= 0.55 and delta_pchembl >= 0.7 and not is_identical_fp
       and target_pref_name in ('NATION_0', 'NATION_1', 'NATION_6', 'NATION_7', 'NATION_13')""",
)
def filter_cliffs(spark, sf):
    chosen = ["NATION_0", "NATION_1", "NATION_6", "NATION_7", "NATION_13"]
    return serving.filter_cliffs(warehouse(spark, sf).mart_activity_cliff, 0.55, 0.7, False, chosen)


@query(
    "ranked_cliffs",
    """select *, row_number() over (order by sali desc nulls last, target_key, compound_key_a, compound_key_b) - 1 as _row,
              molecule_chembl_id_a || ' ⇄ ' || molecule_chembl_id_b as pair from cliff""",
)
def ranked_cliffs(spark, sf):
    return serving.ranked_cliffs(warehouse(spark, sf).mart_activity_cliff)


@query(
    "label_class",
    """select target_key, target_chembl_id, pref_name, target_type, organism, coalesce(label, d.payload_class) as payload_class
       from (select * replace (coalesce(payload_class, target_type) as payload_class) from dim_target) d
            left join label_names l on l.payload_class = d.payload_class""",
)
def label_class(spark, sf):
    targets = warehouse(spark, sf).dim_target.withColumn("payload_class", F.coalesce("payload_class", "target_type"))
    return serving.label_class(targets, "payload_class", ANALOG.class_labels)


@query(
    "cytotox_by_payload",
    """select reference_name, payload_class, max(median_p_cyto) as best_p_cyto,
              count(distinct cell_line_chembl_id) as n_cell_lines from cyto group by 1, 2""",
)
def cytotox_by_payload(spark, sf):
    return serving.cytotox_by_payload(warehouse(spark, sf).mart_compound_cytotoxicity)


@query(
    "library_filter",
    f"""select {_R_CAT} from catalog where best_pchembl between 4.2 and 14 and coalesce(mw_freebase, 0) between 900 and 1050
        and coalesce(alogp, 0) between -1 and 3.5 and coalesce(hbd, 0) between 0 and 6
        and coalesce(num_ro5_violations, 0) <= 3
        and (contains(lower(molecule_chembl_id), 'ring') or contains(lower(coalesce(pref_name, '')), 'ring'))""",
)
def library_filter(spark, sf):
    ranges = {"mw_freebase": (900, 1050), "alogp": (-1, 3.5), "hbd": (0, 6)}
    return tidy(serving.library_filter(warehouse(spark, sf).mart_compound_catalog, (4.2, 14.0), ranges, 3, " Ring "))


@query(
    "contains_features",
    f"""select doc_id, case when n_chars % 11 <> 0 then list_has_all({words('text')}, ['the', 'of']) end as contains
        from documents""",
)
def contains_features(spark, sf):
    docs = table(spark, sf, "documents").select(
        "doc_id", F.when(F.col("n_chars") % 11 != 0, fn.word_set("text")).alias("words")
    )
    return serving.contains_features(docs, "words", ["the", "of"]).select("doc_id", "contains")


@query(
    "containing_sets",
    f"""select item_id, doc_id from (select item_id, {words('text')} as q from benchmark) b
        join doc_sets d on list_has_all(words, q) where len(q) > 0""",
)
def containing_sets(spark, sf):
    """Benchmark passages whose every word occurs in a document (a containment join)."""
    items = table(spark, sf, "benchmark").select("item_id", fn.word_set("text").alias("query"))
    docs = analogs.document_sets(spark, sf)
    return similarity.containing_sets(docs, "doc_id", "words", items, "item_id", "query")


@query(
    "sar_ranking",
    f"""select {_R_SAR} from sar where target_pref_name = 'NATION_1' and n_measurements >= 1
        and median_pchembl between 4 and 14 order by median_pchembl desc, molecule_chembl_id limit 20""",
)
def sar_ranking(spark, sf):
    return tidy(serving.sar_ranking(warehouse(spark, sf).mart_target_sar, "NATION_1", 1, 4.0, 14.0))


_HEAT = tuple(f"NATION_{k}" for k in range(25))


@query(
    "sar_heatmap",
    "select molecule_chembl_id, round(best, 6) as best, "
    + ", ".join(f"round(max(case when target_pref_name = '{t}' then median_pchembl end), 6) as {t}" for t in _HEAT)
    + """ from sar join (select molecule_chembl_id, max(median_pchembl) as best from sar group by 1
                         order by best desc, molecule_chembl_id limit 30) using (molecule_chembl_id) group by 1, best""",
)
def sar_heatmap(spark, sf):
    return tidy(serving.sar_heatmap(warehouse(spark, sf).mart_target_sar, _HEAT))


@query("selectivity_view", f"select {_R_SEL} from sel where n_targets >= 2 and compound_key in ({_SCOPE_SQL})")
def selectivity_view(spark, sf):
    w = warehouse(spark, sf)
    keys = serving.resolve_scope(w.mart_target_sar, w.mart_compound_catalog, _SCOPE)
    return tidy(serving.selectivity_view(w.mart_compound_selectivity, keys))


@query(
    "selectivity_matrix",
    f"with shown as (select * from sar where compound_key in (select compound_key from sel where n_targets >= 2) and compound_key in ({_SCOPE_SQL}))"
    " select molecule_chembl_id, round(best, 6) as best, "
    + ", ".join(f"round(max(case when target_pref_name = '{t}' then median_pchembl end), 6) as {t}" for t in _HEAT)
    + """ from shown join (select molecule_chembl_id, max(median_pchembl) as best from shown group by 1
                           order by best desc, molecule_chembl_id limit 30) using (molecule_chembl_id) group by 1, best""",
)
def selectivity_matrix(spark, sf):
    w = warehouse(spark, sf)
    keys = serving.resolve_scope(w.mart_target_sar, w.mart_compound_catalog, _SCOPE)
    return tidy(serving.selectivity_matrix(w.mart_target_sar, w.mart_compound_selectivity, keys, _HEAT))


@query(
    "distribution",
    """select target_pref_name, count(*) as n, round(min(median_pchembl), 6) as low,
              round(quantile_cont(median_pchembl, 0.25), 6) as p25, round(median(median_pchembl), 6) as median,
              round(quantile_cont(median_pchembl, 0.75), 6) as p75, round(max(median_pchembl), 6) as high
       from sar group by 1""",
)
def distribution(spark, sf):
    return tidy(serving.distribution(warehouse(spark, sf).mart_target_sar, "target_pref_name", "median_pchembl"))


@query(
    "exact_quantiles",
    """select l_returnflag, l_linestatus, round(quantile_cont(l_extendedprice, 0.1), 6) as p10,
              round(median(l_extendedprice), 6) as p50, round(quantile_cont(l_extendedprice, 0.9), 6) as p90
       from lineitem group by 1, 2""",
)
def exact_quantiles(spark, sf):
    """Quantiles of an open value range in very large groups."""
    groups = ["l_returnflag", "l_linestatus"]
    lines = table(spark, sf, "lineitem")
    found = positions.exact_quantiles(lines, groups, "l_extendedprice", [0.1, 0.5, 0.9], "q", rows_per_range=5000)
    picked = {"p10": F.col("q")[0], "p50": F.col("q")[1], "p90": F.col("q")[2]}
    return tidy(found.withColumns(picked).drop("q"))


@query(
    "histogram",
    """select least(floor((p_retailprice - lo) / ((hi - lo) / 40)) + 1, 40)::int as bin, p_size % 2 = 0 as flag, count(*) as n
       from part, (select min(p_retailprice) as lo, max(p_retailprice) as hi from part) group by 1, 2""",
)
def histogram(spark, sf):
    parts = table(spark, sf, "part").withColumn("flag", F.col("p_size") % 2 == 0)
    return serving.histogram(parts, "p_retailprice", "flag")


@query(
    "top_categories",
    """select molecule_chembl_id, murcko_scaffold_smiles,
              case when murcko_scaffold_smiles is null then 'acyclic' when top.s is not null then top.s else 'other' end as series
       from raw_cheminfo left join (
         select murcko_scaffold_smiles as s from raw_cheminfo where murcko_scaffold_smiles is not null group by 1
         order by count(*) desc, 1 limit 10) top on top.s = murcko_scaffold_smiles""",
)
def top_categories(spark, sf):
    scaffolds = warehouse(spark, sf).stg_compound_cheminfo.select("molecule_chembl_id", "murcko_scaffold_smiles")
    return serving.top_categories(scaffolds, "murcko_scaffold_smiles", 10, "series")


@query("series_view", "select * from series where n_compounds >= 3")
def series_view(spark, sf):
    return serving.series_view(warehouse(spark, sf).mart_chemical_series, 3, "pchembl_range")


@query(
    "member_rank",
    """select scaffold_key, molecule_chembl_id, shown as best_pchembl,
              row_number() over (partition by scaffold_key order by potency desc nulls last, molecule_chembl_id) as rank,
              count(*) over (partition by scaffold_key) as n_members, round(shown - max_pchembl, 2) as delta_to_best,
              round(shown - median_pchembl, 2) as delta_to_median
       from (select scaffold_key, molecule_chembl_id, best_pchembl as potency, round(best_pchembl, 2) as shown
             from fp left join potency using (compound_key) where scaffold_key is not null)
            join series using (scaffold_key)""",
)
def member_rank(spark, sf):
    w = warehouse(spark, sf)
    members = serving.series_members(
        w.mart_compound_fingerprint, w.dim_compound, w.mart_target_sar, w.dim_scaffold.select("scaffold_key")
    )
    return serving.member_rank(members, w.mart_chemical_series)


@query("drop_missing", f"select {_R_MOL} from stg_molecules where psa is not null and max_phase is not null")
def drop_missing(spark, sf):
    return tidy(serving.drop_missing(warehouse(spark, sf).stg_molecules, ["psa", "max_phase"]))


@query(
    "entry_label",
    """select pdb_id, concat_ws(' · ', concat_ws(' - ', upper(pdb_id), title), nullif(concat_ws(' · ', nullif(concat_ws(' ',
              case method when 'X-ray diffraction' then 'X-ray' when 'Electron Microscopy' then 'cryo-EM'
                   when 'Solution NMR' then 'NMR' else method end,
              case when resolution is not null then format('{:.1f}', resolution) || ' Å' end), ''),
              year::varchar), '')) as label from stg_summary""",
)
def entry_label(spark, sf):
    return serving.entry_label(warehouse(spark, sf).stg_pdbe_summary).select("pdb_id", "label")


@query(
    "attach_pair_attributes",
    """select l_orderkey, l_linenumber, l_partkey as part_a, l_suppkey as part_b, a.p_name as p_name_a, a.p_type as p_type_a,
              b.p_name as p_name_b, b.p_type as p_type_b
       from lineitem left join part a on a.p_partkey = l_partkey left join part b on b.p_partkey = l_suppkey""",
)
def attach_pair_attributes(spark, sf):
    pairs = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("part_a"), F.col("l_suppkey").alias("part_b")
    )
    parts = table(spark, sf, "part").withColumnRenamed("p_partkey", "part")
    return serving.attach_pair_attributes(pairs, parts, "part", ["p_name", "p_type"])


@query(
    "facet_bounds",
    """select 'mw_freebase' as "column", min(mw_freebase) as low, max(mw_freebase) as high from catalog
       union all select 'hbd', min(hbd)::double, max(hbd)::double from catalog
       union all select 'empty', 0::double, 9::double""",
)
def facet_bounds(spark, sf):
    catalog = warehouse(spark, sf).mart_compound_catalog.withColumn("empty", F.lit(None).cast("int"))
    return serving.facet_bounds(catalog, {"mw_freebase": (0, 1000), "hbd": (0, 10), "empty": (0, 9)})


# --- profiling ---------------------------------------------------------------------------


@query(
    "volume_profile",
    """with counts as (select 'compounds' as layer, count(*) as rows from dim_compound
                       union all select 'activities', count(*) from fact
                       union all select 'fingerprinted', count(*) from fp)
       select layer, rows, round(100::double * rows / (select count(*) from dim_compound), 6) as coverage from counts""",
)
def volume_profile(spark, sf):
    w = warehouse(spark, sf)
    layers = {"compounds": w.stg_molecules, "activities": w.fact_activity, "fingerprinted": w.mart_compound_fingerprint}
    return tidy(profiling.volume_profile(layers, "compounds"))


@query(
    "group_size_profile",
    """select count(*) as groups, count(*) filter (where n_compounds = 1) as singletons,
              count(*) filter (where n_compounds >= 2) as multi_member,
              coalesce(sum(n_compounds) filter (where n_compounds >= 2), 0)::bigint as members_covered,
              max(n_compounds) as largest from dim_scaffold""",
)
def group_size_profile(spark, sf):
    return profiling.group_size_profile(warehouse(spark, sf).dim_scaffold)


@query(
    "largest_groups",
    "select scaffold_key, n_compounds from dim_scaffold order by n_compounds desc, scaffold_key limit 10",
)
def largest_groups(spark, sf):
    return profiling.largest_groups(warehouse(spark, sf).dim_scaffold, "scaffold_key")


@query(
    "pair_budget",
    """select target_key, target_pref_name, count(*) as n, (count(*) * (count(*) - 1) // 2)::bigint as pairs
       from sar join fp using (compound_key) where ecfp4_onbits is not null and median_pchembl is not null group by 1, 2""",
)
def pair_budget(spark, sf):
    w = warehouse(spark, sf)
    return profiling.pair_budget(w.mart_target_sar, w.mart_compound_fingerprint)


_TAUS, _DELTAS = (0.75, 0.8, 0.9, 1.0), (1.0, 2.0, 4.0)


@query(
    "cliff_grid",
    "select tau as min_tanimoto, d as min_delta, count(*) filter (where t >= tau and delta >= d) as n_pairs from doc_scored,"
    " (select unnest([0.75, 0.8, 0.9, 1.0])::double as tau), (select unnest([1.0, 2.0, 4.0])::double as d) group by 1, 2",
)
def cliff_grid(spark, sf):
    return profiling.cliff_grid(_document_pairs(spark, sf, min(_TAUS), min(_DELTAS)), _TAUS, _DELTAS)


@query(
    "top_cliffs",
    """select lang, ida, idb, delta, round(t, 6) as similarity, case when t < 1 then round(delta / (1 - t), 6) else 1e300 end as sali
       from doc_scored where t >= 0.75 and delta >= 1
       order by case when t < 1 then delta / (1 - t) else 1e300 end desc, ida, idb limit 100""",
)
def top_cliffs(spark, sf):
    pairs = _document_pairs(spark, sf).select(
        "lang", F.col("a.doc_id").alias("ida"), F.col("b.doc_id").alias("idb"), "delta", "similarity"
    )
    top = profiling.top_cliffs(pairs, 100, ["ida", "idb"])
    steep = F.when(F.col("sali") == float("inf"), F.lit(1e300)).otherwise(fn.round_fp("sali", 6))
    return top.withColumns({"sali": steep, "similarity": fn.round_fp("similarity", 6)})


@query(
    "cap_per_group",
    f"""select {_R_SAR} from (select * exclude (rn) from (select *, row_number() over (partition by target_key
          order by median_pchembl desc, molecule_chembl_id) as rn from sar) where rn <= 5)""",
)
def cap_per_group(spark, sf):
    return tidy(
        profiling.cap_per_group(warehouse(spark, sf).mart_target_sar, "target_key", "median_pchembl", "molecule_chembl_id", 5)
    )


@query(
    "missing_fingerprints",
    "select count(*) as missing from sar where compound_key not in (select compound_key from fp)",
)
def missing_fingerprints(spark, sf):
    w = warehouse(spark, sf)
    return profiling.missing_fingerprints(w.mart_target_sar, w.mart_compound_fingerprint)


# --- quality -----------------------------------------------------------------------------


@query("check_unique", "select l_partkey, count(*) as n from lineitem where l_partkey is not null group by 1 having count(*) > 1")
def check_unique(spark, sf):
    return quality.check_unique(table(spark, sf, "lineitem"), "l_partkey")


@query("check_not_null", "select molecule_chembl_id, source, xref_id from raw_unichem where xref_id is null")
def check_not_null(spark, sf):
    return quality.check_not_null(analogs.xref_unichem(spark, sf), "xref_id")


@query(
    "check_accepted",
    "select standard_type, count(*) as n from raw_activities where standard_type not in ('IC50', 'Ki') group by 1",
)
def check_accepted(spark, sf):
    return quality.check_accepted(analogs.activities(spark, sf), "standard_type", ["IC50", "Ki"])


@query("check_relationship", "select doc_id, lang, source from documents where doc_id not in (select doc_id from labels)")
def check_relationship(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "lang", "source")
    return quality.check_relationship(documents, "doc_id", table(spark, sf, "labels"), "doc_id")


@query(
    "check_grain",
    "select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1",
)
def check_grain(spark, sf):
    return quality.check_grain(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "check_pair_order",
    """select l_linenumber, l_partkey, l_suppkey, count(*) as n from lineitem group by all
       having count(*) > 1 or l_partkey >= l_suppkey""",
)
def check_pair_order(spark, sf):
    return quality.check_pair_order(table(spark, sf, "lineitem"), "l_linenumber", "l_partkey", "l_suppkey")


@query("check_thresholds", "select * from cliff where tanimoto < 0.55 or delta_pchembl < 0.8")
def check_thresholds(spark, sf):
    return quality.check_thresholds(
        warehouse(spark, sf).mart_activity_cliff, {"tanimoto": 0.55, "delta_pchembl": 0.8}
    )


@query("check_range", f"select {_R_SAR} from sar where median_pchembl < 4.2 or median_pchembl > 5 or max_pchembl < 4.2 or max_pchembl > 5")
def check_range(spark, sf):
    return tidy(quality.check_range(warehouse(spark, sf).mart_target_sar, ["median_pchembl", "max_pchembl"], 4.2, 5.0))


@query(
    "check_null_rate",
    """select 'pref_name' as column_name, round(rate, 6) as null_rate
       from (select avg(case when pref_name is null then 1.0 else 0.0 end) as rate from dim_compound) where rate > 0.1""",
)
def check_null_rate(spark, sf):
    return tidy(quality.check_null_rate(warehouse(spark, sf).stg_molecules, "pref_name", 0.1))


@query(
    "check_row_floor",
    """select model, n from (select 'stg_targets' as model, count(*) as n from stg_targets
       union all select 'fact_activity', count(*) from fact) where n < 25""",
)
def check_row_floor(spark, sf):
    w = warehouse(spark, sf)
    return quality.check_row_floor({"stg_targets": w.stg_targets, "fact_activity": w.fact_activity}, 25)


@query(
    "check_mean_band",
    "select round(m, 6) as mean from (select avg(pchembl_value) as m from fact) where m < 5 or m > 10",
)
def check_mean_band(spark, sf):
    return tidy(quality.check_mean_band(warehouse(spark, sf).fact_activity, "pchembl_value", 5.0, 10.0))


@query(
    "check_one_open_window",
    "select o_custkey, count(*) as open_windows from orders where o_orderstatus <> 'F' group by 1 having count(*) > 1",
)
def check_one_open_window(spark, sf):
    closed = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))
    return quality.check_one_open_window(table(spark, sf, "orders").withColumn("valid_to", closed), "o_custkey")


@query(
    "check_known_class",
    """select target_key, target_chembl_id, pref_name, payload_class from dim_target
       where payload_class is null or payload_class not in ('tubulin_inhibitor', 'topo1_inhibitor')""",
)
def check_known_class(spark, sf):
    targets = warehouse(spark, sf).dim_target.select("target_key", "target_chembl_id", "pref_name", "payload_class")
    return quality.check_known_class(targets, "payload_class", ["tubulin_inhibitor", "topo1_inhibitor"])


@query(
    "check_reconciles",
    """select a_n, b_n from (select sum(n_compounds)::bigint as a_n from series),
              (select count(distinct compound_key) as b_n from fp) where a_n <> b_n""",
)
def check_reconciles(spark, sf):
    """Series members against all fingerprinted compounds: the acyclic ones are the gap."""
    w = warehouse(spark, sf)
    return quality.check_reconciles(
        w.mart_chemical_series, F.sum("n_compounds"), w.mart_compound_fingerprint, F.count_distinct("compound_key")
    )


@query(
    "freshness",
    """select strftime(m, '%Y-%m-%d %H:%M:%S') as newest, (epoch_ms(timestamp '2024-12-31') // 1000 - epoch_ms(m) // 1000)::bigint as age_seconds,
              case when epoch_ms(timestamp '2024-12-31') // 1000 - epoch_ms(m) // 1000 > 315360000 then 'error'
                   when epoch_ms(timestamp '2024-12-31') // 1000 - epoch_ms(m) // 1000 > 7776000 then 'warn' else 'pass' end as status
       from (select max(ts) as m from events)""",
)
def freshness(spark, sf):
    found = quality.freshness(table(spark, sf, "events"), F.col("ts"), F.lit("2024-12-31"))
    return found.withColumn("newest", F.date_format("newest", "yyyy-MM-dd HH:mm:ss"))


@query(
    "check_suite",
    """with v as (
         select 'assay_grain' as "check", count(*) - count(distinct assay_chembl_id) as violations from dim_assay
         union all select 'line_grain', count(*) from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)
         union all select 'price_positive', count(*) from lineitem where l_extendedprice <= 0
         union all select 'discount_capped', count(*) from lineitem where l_discount > 0.09::double
         union all select 'flag_known', count(*) from lineitem where l_returnflag not in ('A', 'N'))
       select "check", violations, violations = 0 as passed from v""",
)
def check_suite(spark, sf):
    w, lines = warehouse(spark, sf), table(spark, sf, "lineitem")
    return quality.check_suite(
        {
            "assay_grain": quality.check_grain(w.stg_assays, ["assay_chembl_id"]),
            "line_grain": quality.check_grain(lines, ["l_orderkey", "l_linenumber"]),
        },
        [
            (
                lines,
                {
                    "price_positive": F.col("l_extendedprice") <= 0,
                    "discount_capped": F.col("l_discount") > 0.09,
                    "flag_known": ~F.col("l_returnflag").isin("A", "N"),
                },
            )
        ],
    )


_CHECK_VIEWS = {
    "stg_activities": "stg_activities",
    "stg_molecules": "stg_molecules",
    "stg_targets": "stg_targets",
    "stg_assays": "stg_assays",
    "dim_compound": "dim_compound",
    "dim_target": "dim_target",
    "dim_assay": "dim_assay",
    "dim_scaffold": "dim_scaffold",
    "mart_target_sar": "sar",
    "mart_compound_selectivity": "sel",
    "mart_compound_xref": "xref",
    "mart_compound_pdb": "pdb",
    "mart_chemical_series": "series",
}


def _check_sql() -> str:
    """The declared checks of the models above as SQL, one count each."""
    parts = []
    for model, columns in checks.NOT_NULL.items():
        parts += [(f"{model}.{c} not_null", f"select 1 from {_CHECK_VIEWS[model]} where {c} is null") for c in columns if model in _CHECK_VIEWS]
    for model, column, low, high in checks.BANDS:
        bad = " or ".join([f"{column} < {low}"] * (low is not None) + [f"{column} > {high}"] * (high is not None))
        parts += [(f"{model}.{column} in_band", f"select 1 from {_CHECK_VIEWS[model]} where {bad}")] if model in _CHECK_VIEWS else []

    def listed(values) -> str:
        return ", ".join(f"'{v}'" for v in values)

    config = ANALOG
    parts.append(("stg_activities.standard_type accepted", f"select 1 from stg_activities where standard_type not in ({listed(config.standard_types)})"))
    parts.append(("stg_targets.target_type accepted", f"select 1 from stg_targets where target_type not in ({listed(checks.TARGET_TYPES)})"))
    classes = listed(sorted({c for _, c in config.payload_classes}))
    parts.append(("dim_target.payload_class known", f"select 1 from dim_target where coalesce(payload_class not in ({classes}), true)"))
    for model, c in checks.UNIQUE:
        if model in _CHECK_VIEWS:
            parts.append((f"{model}.{c} unique", f"select 1 from {_CHECK_VIEWS[model]} where {c} is not null group by {c} having count(*) > 1"))
    for child, fk, parent, pk in checks.REFERENCES:
        if child in _CHECK_VIEWS and parent in _CHECK_VIEWS:
            sql = f"select 1 from {_CHECK_VIEWS[child]} where {fk} is not null and {fk} not in (select {pk} from {_CHECK_VIEWS[parent]})"
            parts.append((f"{child}.{fk} references {parent}", sql))
    for model, columns in checks.GRAINS:
        if model in _CHECK_VIEWS:
            parts.append((f"{model} grain", f"select 1 from {_CHECK_VIEWS[model]} group by {', '.join(columns)} having count(*) > 1"))
    floors = " union all ".join(f"select count(*) as n from {m}" for m in ("stg_activities", "dim_compound"))
    parts.append(("row floors", f"select 1 from ({floors}) where n < 3"))
    parts.append(("dim_compound.canonical_smiles null_rate", "select 1 from (select avg((canonical_smiles is null)::int) as r from dim_compound) where r > 0.2"))
    counts = " union all ".join(f"select '{name}' as \"check\", (select count(*) from ({sql})) as violations" for name, sql in parts)
    return f'select "check", violations, violations = 0 as passed from ({counts})'


@query("warehouse_checks", _check_sql())
def warehouse_checks(spark, sf):
    """The declared checks of the models that the SQL definitions cover, over the models written once."""
    w = warehouse(spark, sf)
    for model in _CHECK_VIEWS:
        w.__dict__[model] = materialize(getattr(w, model), model)
    return checks.warehouse_checks(w, models=list(_CHECK_VIEWS))
