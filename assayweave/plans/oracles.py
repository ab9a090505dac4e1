"""DuckDB definitions of every registered query, on the driver tables.

``VIEWS`` are named building blocks (the analog entities and the layers on top);
``QUERIES`` are the final selects. ``oracle_sql`` prepends the blocks a query needs.
"""

from __future__ import annotations

import re

from ..config import CLASS_LABELS, XREF_SOURCES
from .analogs import ANALOG_CLASSES


def _values(rows: tuple[tuple[str, ...], ...], columns: str) -> str:
    body = ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in row) + ")" for row in rows)
    return f"select * from (values {body}) v({columns})"


def _first(source: str, key: str, columns: list[str]) -> str:
    """One row per key, the smallest by the listed columns in order."""
    order = ", ".join(f"{c} asc nulls last" for c in columns)
    return (
        f"select * exclude (rn_) from (select *, row_number() over (partition by {key} order by {order}) rn_"
        f" from {source}) where rn_ = 1"
    )


_ACT = (
    "molecule_chembl_id target_chembl_id assay_chembl_id standard_type standard_relation standard_value"
    " standard_units pchembl_value document_chembl_id"
).split()
_MOL = (
    "pref_name max_phase is_approved_drug molecule_type canonical_smiles inchi_key mw_freebase alogp hba hbd psa"
    " rotatable_bonds num_ro5_violations ro3_pass aromatic_rings qed_weighted"
).split()
_CELL = (
    "molecule_chembl_id molecule_pref_name canonical_smiles payload_class reference_name cell_line_chembl_id cell_line"
    " assay_chembl_id standard_type standard_relation standard_value standard_units"
).split()

_WORDS = (
    r"list_sort(list_distinct(list_filter(string_split_regex(lower({0}), '[^\pL\pM\pN]+'), lambda w: w <> '')))"
)


def words(column: str) -> str:
    return _WORDS.format(column)


def tanimoto(a: str, b: str) -> str:
    shared = f"len(list_intersect({a}, {b}))"
    return f"{shared}::double / (len({a}) + len({b}) - {shared})"


VIEWS: dict[str, str] = {
    # raw analogs
    "raw_activities": """
        select l_orderkey * 10 + l_linenumber as activity_id, 'M' || l_partkey as molecule_chembl_id,
               'T' || s_nationkey as target_chembl_id, 'A' || l_orderkey as assay_chembl_id,
               case l_returnflag when 'A' then 'IC50' when 'N' then 'Ki' else 'Inhibition' end as standard_type,
               case when l_linestatus = 'O' then '=' else '>' end as standard_relation,
               l_extendedprice as standard_value, 'nM' as standard_units,
               case when l_quantity <> 1 then round(-log10(l_extendedprice * 1e-9), 2) end as pchembl_value,
               case when l_discount >= 0.1::double then 'Outside typical range' end as data_validity_comment,
               'D' || l_suppkey as document_chembl_id
        from lineitem join supplier on s_suppkey = l_suppkey""",
    "raw_molecules": """
        select 'M' || p_partkey as molecule_chembl_id, case when p_size % 7 <> 0 then p_name end as pref_name,
               case when p_size % 5 <> 0 then (p_size % 6)::double end as max_phase, p_type as molecule_type,
               case when p_size % 6 = 0 then null when p_size % 6 = 1 then 'null' when p_size % 6 = 2 then '[]'
                    when p_size % 6 = 3 then '{"xref_src":"PDBe","xref_id":"L1"}'
                    else '[{"xref_src":"PubChem","xref_id":"' || p_partkey || '","xref_name":"n"},'
                      || '{"xref_src":"PDBe","xref_id":"L' || p_size || '","xref_name":null},'
                      || '{"xref_src":null,"xref_id":"z"}]' end as cross_references,
               case when p_size <> 50 then p_brand || '-' || p_type || '-' || p_name end as smiles,
               md5(p_name) as inchi, p_retailprice as mw, p_size::double / 10::double - 1::double as alogp,
               p_size % 12 as hba, p_size % 8 as hbd, case when p_size % 9 <> 0 then p_retailprice * 0.5::double end as psa,
               length(p_name) as rtb, case when p_size % 9 <> 0 then p_size % 5 end as ro5,
               case when p_size < 10 then 'Y' else 'N' end as ro3, p_size % 4 as rings, p_size::double / 50::double as qed
        from part""",
    "raw_targets": """
        select 'T' || n_nationkey as target_chembl_id, n_name as pref_name,
               case when n_regionkey = 4 then 'Rattus norvegicus' else 'Homo sapiens' end as organism,
               case when n_regionkey = 0 then 'PROTEIN FAMILY' else 'SINGLE PROTEIN' end as target_type,
               (n_regionkey + 9606)::bigint as tax_id
        from nation""",
    "raw_assays": """
        select 'A' || o_orderkey as assay_chembl_id, o_orderpriority as description,
               case o_orderstatus when 'F' then 'F' when 'O' then 'B' else 'A' end as assay_type,
               (8 - substr(o_orderpriority, 1, 1)::int) || '.0' as confidence_score, null::varchar as target_chembl_id
        from orders""",
    "raw_cell": """
        select event_id as activity_id, 'M' || user_id as molecule_chembl_id,
               case when user_id % 7 <> 0 then 'Molecule ' || user_id end as molecule_pref_name,
               null::varchar as canonical_smiles,
               case when user_id % 3 = 0 then 'tubulin_inhibitor' else 'topo1_inhibitor' end as payload_class,
               'Ref' || (user_id % 10) as reference_name, 'C_' || event_type as cell_line_chembl_id,
               event_type as cell_line, 'A' || event_id as assay_chembl_id,
               case when event_type in ('view', 'click') then 'GI50' when event_type = 'error' then 'Potency'
                    else 'IC50' end as standard_type,
               case when value < 1 then '>' else '=' end as standard_relation, value as standard_value,
               ['nM', 'uM', 'M', 'pM', 'ug/mL'][event_id % 5 + 1] as standard_units
        from events""",
    "raw_unichem": """
        select 'M' || doc_id as molecule_chembl_id, ['pubchem', 'pdbe', 'drugbank', 'newDb'][doc_id % 4 + 1] as source,
               case when n_chars % 11 <> 0 then 'L' || (doc_id % 50) end as xref_id
        from documents""",
    "raw_structures": """
        select 'L' || user_id as xref_id, case when event_type <> 'signup' then 'p' || event_id end as pdb_id from events""",
    "raw_summary": """
        select 'P' || o_orderkey as pdb_id, case when o_orderstatus <> 'P' then 'Entry ' || o_orderkey end as title,
               case substr(o_orderpriority, 1, 1) when '1' then 'X-ray diffraction' when '2' then 'Electron Microscopy'
                    when '3' then 'Solution NMR' when '4' then 'Other' end as method,
               case when o_orderstatus = 'P' then 'n/a' else year(o_orderdate)::varchar end as year,
               case when o_orderpriority[1] = '5' then 'unknown' else round(o_totalprice / 100000, 2)::varchar end as resolution
        from orders""",
    "raw_cheminfo": """
        select 'M' || vec_id as molecule_chembl_id, null::varchar as canonical_smiles,
               list_filter(list_transform(range(64), lambda i: case when embedding[i + 1] > 0 then i::int end),
                           lambda x: x is not null) as ecfp4_onbits,
               label + 10 as heavy_atom_count,
               case when p_size % 10 <> 0 then p_brand || ' ' || p_type end as murcko_scaffold_smiles,
               case when p_size % 10 <> 0 then p_type end as murcko_generic_smiles
        from embeddings left join part on p_partkey = vec_id""",
    # staging
    "stg_activities": _first(
        "(select activity_id, " + ", ".join(_ACT) + " from raw_activities where pchembl_value is not null"
        " and standard_relation = '=' and data_validity_comment is null"
        " and standard_type in ('IC50', 'GI50', 'Ki', 'Kd', 'EC50'))",
        "activity_id",
        _ACT,
    ),
    "stg_molecules": """
        select molecule_chembl_id, pref_name, max_phase, coalesce(max_phase >= 4, false) as is_approved_drug, molecule_type,
               smiles as canonical_smiles, inchi as inchi_key, mw as mw_freebase, alogp, hba::int as hba, hbd::int as hbd, psa,
               rtb::int as rotatable_bonds, ro5::int as num_ro5_violations, ro3 as ro3_pass, rings::int as aromatic_rings,
               qed as qed_weighted
        from raw_molecules""",
    "stg_targets": "select * from raw_targets where organism = 'Homo sapiens'",
    "stg_assays": """
        select * replace (confidence_score::double::int as confidence_score) from raw_assays
        where confidence_score::double >= 5""",
    "stg_cell": "select *, -log10(standard_value * case standard_units when 'M' then 1::double when 'uM' then 1e-6"
    " when 'nM' then 1e-9 when 'pM' then 1e-12 end) as p_cyto from raw_cell where standard_relation = '='"
    " and standard_type in ('GI50', 'IC50') and standard_units in ('M', 'uM', 'nM', 'pM') and standard_value > 0",
    "stg_xref": """
        select molecule_chembl_id, lower(ref->>'$.xref_src') as source, ref->>'$.xref_id' as xref_id,
               ref->>'$.xref_name' as xref_name
        from (select molecule_chembl_id, unnest(json_extract(cross_references, '$[*]')) as ref from raw_molecules
              where cross_references like '[%')
        where ref->>'$.xref_src' is not null and ref->>'$.xref_id' is not null""",
    "stg_unichem": "select * from raw_unichem where molecule_chembl_id is not null and xref_id is not null",
    "stg_structure": """
        select xref_id as ligand_code, pdb_id from raw_structures where xref_id is not null and pdb_id is not null""",
    "stg_summary": """
        select lower(pdb_id) as pdb_id, title, method, try_cast(year as int) as year,
               try_cast(resolution as double) as resolution
        from raw_summary""",
    # star schema
    "dim_compound": "select row_number() over (order by molecule_chembl_id) as compound_key, * from stg_molecules",
    "payload_class": _values(ANALOG_CLASSES, "target_chembl_id, payload_class"),
    "dim_target": """
        select row_number() over (order by target_chembl_id) as target_key, target_chembl_id, pref_name, target_type,
               organism, payload_class
        from stg_targets left join payload_class using (target_chembl_id)""",
    "dim_assay": """
        select row_number() over (order by assay_chembl_id) as assay_key, assay_chembl_id, description, assay_type,
               confidence_score
        from stg_assays""",
    "dim_scaffold": """
        select row_number() over (order by murcko_scaffold_smiles) as scaffold_key, *
        from (select murcko_scaffold_smiles, min(murcko_generic_smiles) as murcko_generic_smiles,
                     count(distinct molecule_chembl_id) as n_compounds
              from raw_cheminfo where murcko_scaffold_smiles is not null group by 1)""",
    "fact": """
        select activity_id, compound_key, target_key, assay_key, standard_type, standard_relation, standard_value,
               standard_units, pchembl_value, document_chembl_id
        from stg_activities join dim_compound using (molecule_chembl_id) join dim_target using (target_chembl_id)
             join dim_assay using (assay_chembl_id)""",
    # marts (unrounded inside)
    "sar": """
        select compound_key, target_key, c.molecule_chembl_id, t.target_chembl_id, t.pref_name as target_pref_name,
               t.payload_class, median(pchembl_value) as median_pchembl, max(pchembl_value) as max_pchembl,
               count(*) as n_measurements, count(distinct assay_key) as n_assays
        from fact f join dim_compound c using (compound_key) join dim_target t using (target_key) group by all""",
    "sel": """
        select compound_key, molecule_chembl_id, count(*) as n_targets, max(median_pchembl) as best_pchembl,
               max(case when rn = 1 then target_chembl_id end) as best_target,
               max(case when rn = 2 then median_pchembl end) as second_best_pchembl,
               best_pchembl - second_best_pchembl as selectivity_index,
               best_pchembl - min(median_pchembl) as pchembl_spread
        from (select *, row_number() over (partition by compound_key order by median_pchembl desc, target_chembl_id) as rn
              from sar)
        group by all""",
    "fp": """
        select compound_key, c.molecule_chembl_id, ecfp4_onbits, len(ecfp4_onbits) as n_onbits, heavy_atom_count,
               murcko_scaffold_smiles, scaffold_key
        from raw_cheminfo i join dim_compound c on i.molecule_chembl_id = c.molecule_chembl_id
             left join dim_scaffold using (murcko_scaffold_smiles)""",
    "potency": """
        select compound_key, max(median_pchembl) as best_pchembl, count(distinct target_key) as n_targets
        from sar group by 1""",
    "series": """
        select d.scaffold_key, d.murcko_scaffold_smiles, d.murcko_generic_smiles,
               count(distinct f.compound_key) as n_compounds,
               count(distinct case when best_pchembl is not null then f.compound_key end) as n_measured_compounds,
               max(coalesce(r.n_targets, 0)) as n_targets, round(median(best_pchembl), 2) as median_pchembl,
               round(max(best_pchembl), 2) as max_pchembl, round(min(best_pchembl), 2) as min_pchembl,
               round(max(best_pchembl) - min(best_pchembl), 2) as pchembl_range,
               (min({p: -best_pchembl, id: molecule_chembl_id}) filter (where best_pchembl is not null)).id as top_compound
        from dim_scaffold d join fp f on f.scaffold_key = d.scaffold_key left join potency p using (compound_key)
             left join (select scaffold_key, count(distinct target_key) as n_targets from fp join sar using (compound_key)
                        group by 1) r on r.scaffold_key = d.scaffold_key
        group by all""",
    "scored": f"""
        select target_key, a.compound_key as ka, b.compound_key as kb, a.median_pchembl as pa, b.median_pchembl as pb,
               abs(a.median_pchembl - b.median_pchembl) as delta, fa.molecule_chembl_id as ida,
               fb.molecule_chembl_id as idb, fa.murcko_scaffold_smiles = fb.murcko_scaffold_smiles as same_scaffold,
               {tanimoto("fa.ecfp4_onbits", "fb.ecfp4_onbits")} as t
        from sar a join sar b using (target_key) join fp fa on fa.compound_key = a.compound_key
             join fp fb on fb.compound_key = b.compound_key
        where a.compound_key < b.compound_key and abs(a.median_pchembl - b.median_pchembl) >= 0.5""",
    "cliff": """
        select target_key, d.pref_name as target_pref_name, ka as compound_key_a, kb as compound_key_b,
               ida as molecule_chembl_id_a, idb as molecule_chembl_id_b, round(pa, 2) as pchembl_a,
               round(pb, 2) as pchembl_b, round(delta, 2) as delta_pchembl, round(t, 3) as tanimoto,
               t >= 1 as is_identical_fp, same_scaffold, case when t < 1 then round(delta / (1 - t), 2) end as sali
        from scored join dim_target d using (target_key) where t >= 0.5""",
    "lookup": _values(XREF_SOURCES, "source, display_name, url_template"),
    "xref": """
        select distinct compound_key, x.molecule_chembl_id, x.source,
               coalesce(display_name, upper(x.source[1]) || substr(x.source, 2)) as display_name, xref_id,
               replace(url_template, '{id}', xref_id) as url
        from (select molecule_chembl_id, source, xref_id from stg_xref
              union all select molecule_chembl_id, source, xref_id from stg_unichem) x
             join dim_compound using (molecule_chembl_id) left join lookup l on l.source = x.source""",
    "pdb": """
        select distinct compound_key, x.molecule_chembl_id, ligand_code, pdb_id, title, method, year, resolution
        from (select molecule_chembl_id, xref_id as ligand_code from stg_xref where source = 'pdbe'
              union select molecule_chembl_id, xref_id from stg_unichem where source = 'pdbe') x
             join dim_compound using (molecule_chembl_id) join stg_structure using (ligand_code)
             left join stg_summary using (pdb_id)""",
    "catalog": """
        select c.*, s.n_targets, s.best_pchembl, s.best_target, t.payload_class, s.selectivity_index,
               coalesce(n, 0) as n_pdb_entries, coalesce(n, 0) > 0 as has_pdb
        from sel s join dim_compound c using (compound_key)
             left join (select compound_key, count(distinct pdb_id) as n from pdb group by 1) p using (compound_key)
             left join dim_target t on t.target_chembl_id = s.best_target""",
    "cyto": """
        select molecule_chembl_id, min(molecule_pref_name) as molecule_pref_name, min(reference_name) as reference_name,
               min(payload_class) as payload_class, cell_line_chembl_id, min(cell_line) as cell_line,
               count(*) as n_measurements, round(median(round(p_cyto, 6)), 3) as median_p_cyto,
               round(max(round(p_cyto, 6)), 3) as max_p_cyto
        from stg_cell group by molecule_chembl_id, cell_line_chembl_id""",
    "doc_sets": f"select doc_id, lang, (doc_id % 7)::double as potency, {words('text')} as words from documents",
    # Words as 64-bit hashes: list intersections on integers are much faster than on text.
    "doc_codes": "select doc_id, lang, potency, list_transform(words, lambda w: hash(w)) as codes, len(words) as n"
    " from doc_sets where len(words) > 0",
    "doc_scored": """
        select lang, ida, idb, pa, pb, abs(pa - pb) as delta, shared::double / (na + nb - shared) as t
        from (select a.lang, a.doc_id as ida, b.doc_id as idb, a.potency as pa, b.potency as pb, a.n as na, b.n as nb,
                     len(list_intersect(a.codes, b.codes)) as shared
              from doc_codes a join doc_codes b on a.lang = b.lang and a.doc_id < b.doc_id
                   and a.potency <> b.potency and least(a.n, b.n) >= 0.75 * greatest(a.n, b.n) - 1e-6)""",
    "label_names": _values(CLASS_LABELS, "payload_class, label"),
    "scd_v1": "select c_custkey, c_acctbal, c_mktsegment from customer",
    "scd_v2": """
        select c_custkey, c_acctbal + case when c_custkey % 10 = 0 then 100 else 0 end::double as c_acctbal, c_mktsegment
        from customer where c_custkey % 97 <> 0
        union all select c_custkey + 1000000, c_acctbal, c_mktsegment from customer where c_custkey % 50 = 0""",
    "scd_history": """
        select c_custkey, v1.c_acctbal, v1.c_mktsegment, timestamp '2024-01-01' as valid_from,
               case when v2.c_custkey is null or v1.c_acctbal is distinct from v2.c_acctbal
                      or v1.c_mktsegment is distinct from v2.c_mktsegment then timestamp '2024-06-01' end as valid_to
        from scd_v1 v1 left join scd_v2 v2 using (c_custkey)
        union all
        select c_custkey, v2.c_acctbal, v2.c_mktsegment, timestamp '2024-06-01', null
        from scd_v2 v2 left join scd_v1 v1 using (c_custkey)
        where v1.c_custkey is null or v1.c_acctbal is distinct from v2.c_acctbal
           or v1.c_mktsegment is distinct from v2.c_mktsegment""",
}

QUERIES: dict[str, str] = {}


def _needed(sql: str, blocks: list[str], open_: tuple[str, ...] = ()) -> None:
    for name in VIEWS:
        if name not in blocks and name not in open_ and re.search(rf"\b{name}\b", sql):
            _needed(VIEWS[name], blocks, (*open_, name))
            blocks.append(name)


def expand(sql: str) -> str:
    """Prepend the named blocks a select refers to, in dependency order."""
    blocks: list[str] = []
    _needed(sql, blocks)
    if not blocks:
        return sql.strip()
    parts = ",\n".join(f"{name} as ({VIEWS[name].strip()})" for name in blocks)
    body = sql.strip()
    if body.startswith("with "):
        return f"with {parts},\n{body[5:]}"
    return f"with {parts}\n{body}"


def oracle_sql() -> dict[str, str]:
    return {name: expand(sql) for name, sql in QUERIES.items()}
