"""Column functions on names and texts."""

from pyspark.sql import functions as F

from landfall.bindings.adapters import day_number, places
from landfall.bindings.registry import query, table
from landfall.functions import (
    contains_token,
    expand_abbreviations,
    mdy_to_date,
    mdy_to_iso,
    repair_latin1,
    sas_day_to_date,
    sas_day_to_iso,
    split_compound,
    title_case,
    to_ascii,
)
from landfall.operators import accepted, place_parts, redirect_codes, rejected, repair_names, split_dictionary


@query("""
    select l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') as iso_shipdate,
           cast(l_shipdate as date) as ship_date
    from lineitem
""")
def sas_day_to_iso_text(spark, sf_dir):
    day = day_number("l_shipdate") + F.col("l_discount")
    lines = table(spark, sf_dir, "lineitem").withColumn("day", day)
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        sas_day_to_iso("day").alias("iso_shipdate"),
        sas_day_to_date("day").alias("ship_date"),
    )


@query("""
    select o_orderkey,
           case when o_orderstatus <> 'P' then strftime(o_orderdate, '%Y-%m-%d') end as iso_orderdate,
           case when o_orderstatus <> 'P' then cast(o_orderdate as date) end as order_date,
           case when o_orderstatus = 'P' then '-D/-S' else strftime(o_orderdate, '%Y-%m-%d') end as reordered
    from orders
""")
def mmddyyyy_to_iso(spark, sf_dir):
    text = F.when(F.col("o_orderstatus") == "P", "D/S").otherwise(F.date_format("o_orderdate", "MMddyyyy"))
    orders = table(spark, sf_dir, "orders").withColumn("due", text)
    return orders.select(
        "o_orderkey",
        mdy_to_iso("due").alias("iso_orderdate"),
        mdy_to_date("due").alias("order_date"),
        mdy_to_iso("due", lenient=True).alias("reordered"),
    )


@query("select p_partkey, 'Small '||upper(p_type[1])||lower(p_type[2:]) as title from part")
def title_case_words(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", title_case(F.concat(F.lit("sMALL "), "p_type")).alias("title")
    )


@query("""
    select p_partkey,
           regexp_replace(regexp_replace(p_name, '\\bring\\b', 'Ring International', 'g'),
                          '^(small|large)\\b', '\\1 size', 'g') as expanded
    from part
""")
def abbreviation_rules(spark, sf_dir):
    rules = [(r"\bring\b", "Ring International"), (r"^(small|large)\b", "$1 size")]
    return table(spark, sf_dir, "part").select("p_partkey", expand_abbreviations("p_name", rules).alias("expanded"))


@query("select doc_id, text as repaired, text as untouched from documents")
def mojibake_repair(spark, sf_dir):
    garbled = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    documents = table(spark, sf_dir, "documents").withColumn("garbled", garbled)
    return documents.select(
        "doc_id", repair_latin1("garbled").alias("repaired"), repair_latin1("text").alias("untouched")
    )


@query("select doc_id, replace(strip_accents(text), 'ß', 'ss') as plain from documents")
def transliterate(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", to_ascii("text").alias("plain"))


@query("select doc_id, contains(text, 'the ') as has_the from documents")
def contains_word(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", contains_token("text", "the ").alias("has_the"))


@query("""
    select p_partkey, split_part(p_brand, '#', 1) as head, split_part(p_brand, '#', 2) || '#' || p_type as rest
    from part
""")
def compound_code_split(spark, sf_dir):
    head, rest = split_compound(F.concat("p_brand", F.lit("#"), "p_type"), "#")
    return table(spark, sf_dir, "part").select("p_partkey", head.alias("head"), rest.alias("rest"))


def _supplier_labels(spark, sf_dir):
    """A label line per supplier; facility, blanks and surplus parts depend on its balance."""
    suppliers = table(spark, sf_dir, "supplier")
    nations = places(spark, sf_dir)
    balance = F.col("s_acctbal")
    place = F.concat("n_name", F.lit(","), "r_name", F.lit("   "))
    label = (
        F.when(balance > 8000, F.concat("s_name", F.lit(", Dock, "), place))
        .when(balance > 5000, F.concat("s_name", F.lit(", "), place))
        .when(balance > 1000, place)
        .when(balance > 0, F.col("n_name"))
        .otherwise("No PORT Code")
    )
    line = F.concat(F.lit("'"), F.col("s_suppkey").cast("string"), F.lit("'\t=\t'"), label, F.lit("'  "))
    return suppliers.join(nations, suppliers.s_nationkey == nations.n_nationkey).select(line.alias("value"))


@query("""
    select cast(s_suppkey as varchar) as code,
           case when s_acctbal > 5000 and s_acctbal <= 8000 then s_name else '' end as port,
           n_name as locality, r_name as province
    from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
    where s_acctbal > 1000
""")
def label_parse(spark, sf_dir):
    entries = split_dictionary(_supplier_labels(spark, sf_dir), ["code", "label"])
    parsed = accepted(place_parts(entries, "label", ["locality", "province"], "port"))
    return parsed.select("code", "port", "locality", "province")


@query("""
    select cast(s_suppkey as varchar) as code,
           case when s_acctbal > 8000 then 'too many parts'
                when s_acctbal > 0 then 'too few parts' else 'withdrawn' end as problem
    from supplier
    where s_acctbal > 8000 or s_acctbal <= 1000
""")
def label_rejects(spark, sf_dir):
    entries = split_dictionary(_supplier_labels(spark, sf_dir), ["code", "label"])
    return rejected(place_parts(entries, "label", ["locality", "province"], "port")).select("code", "problem")


@query("""
    with labels as (
        select *, p_partkey % 50 in (48, 49) as turns from part
    ), ends as (
        select *, max(case when p_type <> 'PROMO' or turns then p_partkey end) over (order by p_partkey) as last from labels
    )
    select cast(a.p_partkey as varchar) as code,
           case when not coalesce(b.turns, false)
                then cast(coalesce(a.last, (select min(p_partkey) - 1 from part)) as varchar) end as target,
           case when not b.turns and b.p_type <> 'ECONOMY' then b.p_name end as label,
           coalesce(b.turns, false) as circular
    from ends a left join labels b on a.last = b.p_partkey
    where a.p_type <> 'ECONOMY' or a.turns
""")
def collapsed_code_redirect(spark, sf_dir):
    """Chains of collapsed codes; pairs that name each other go round for ever."""
    turns = (F.col("p_partkey") % 50).isin(48, 49)
    step = F.when(F.col("p_partkey") % 50 == 48, 1).otherwise(-1)
    previous = (F.col("p_partkey") + step).cast("string")
    label = (
        F.when(turns | (F.col("p_type") == "PROMO"), F.concat(F.lit("Collapsed ("), previous, F.lit(") 06/15")))
        .when(F.col("p_type") == "ECONOMY", "No PORT Code (X)")
        .otherwise(F.col("p_name"))
    )
    entries = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("code"), label.alias("label")
    )
    found = redirect_codes(entries, "code", "label")
    target = F.when(~F.col("circular"), F.col("target"))
    return found.select("code", target.alias("target"), "label", "circular")


_SPELLINGS = """(
    select 'part' as kind, p_name as name, p_partkey as id from part
    union all select 'supplier', s_name, s_suppkey from supplier
)"""


def _spellings(spark, sf_dir):
    """Names of parts and suppliers with a mistake: a letter lost, replaced, or one too many and the last one lost."""
    parts = table(spark, sf_dir, "part").select(F.lit("part").alias("kind"), F.col("p_name").alias("known"), F.col("p_partkey").alias("id"))
    suppliers = table(spark, sf_dir, "supplier").select(F.lit("supplier"), "s_name", "s_suppkey")
    names = parts.union(suppliers)
    known = F.col("known")
    at = (F.col("id") % F.length(known) + 1).cast("int")
    rest = F.substring(known, at + 1, F.length(known))
    before = F.substring(known, F.lit(1), at - 1)
    wrong = (
        F.when(F.col("id") % 3 == 0, F.concat(before, rest))
        .when(F.col("id") % 3 == 1, F.concat(before, F.lit("x"), rest))
        .otherwise(F.concat(before, F.lit("q"), F.substring(known, at, F.length(known) - at)))
    )
    return names.withColumn("name", wrong)


@query(f"""
    with wrong as (
        select distinct kind, substr(name, 1, n - 1) || case id % 3 when 0 then substr(name, n + 1)
                    when 1 then 'x' || substr(name, n + 1) else 'q' || substr(name, n, length(name) - n) end as name
        from (select *, cast(id % length(name) + 1 as integer) as n from {_SPELLINGS})
    ), known as (
        select distinct kind, name as known from {_SPELLINGS}
    ), pairs as (
        select wrong.kind, name, known, levenshtein(name, known) as distance
        from wrong join known on wrong.kind = known.kind and levenshtein(name, known) <= 2
        where name not in (select known from known k where k.kind = wrong.kind)
    ), nearest as (
        select kind, name, distance, list(known order by known) as candidates from pairs
        where distance = (select min(p.distance) from pairs p where p.kind = pairs.kind and p.name = pairs.name)
        group by all
    )
    select w.kind, w.name, case when len(candidates) = 1 then candidates[1] end as repaired,
           cast(distance as integer) as distance, coalesce(array_to_string(candidates, '|'), '') as candidates
    from wrong w left join nearest n on w.kind = n.kind and w.name = n.name
    where w.name not in (select known from known k where k.kind = w.kind)
""")
def name_repair(spark, sf_dir):
    """Misspelt names of parts and suppliers, found again where one known name is nearest; ties are told."""
    names = _spellings(spark, sf_dir)
    found = repair_names(names, "name", names, "known", within=["kind"])
    return found.withColumn("candidates", F.array_join("candidates", "|"))
