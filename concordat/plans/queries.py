"""One registered query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session
from ..functions import identifiers, text
from ..operators import (
    catalogue, contract, coverage, documents, edges, estimation, export, inventory, joins, linkage, loads, profile, provenance,
    publish, registry,
)
from ..operators.contract import Rule
from ..operators.coverage import Join
from ..sources import descriptors, objects, readers
from .crosswalk import ORDER, build_crosswalk, publish_crosswalk
from .inputs import TABLES, Inputs, identifier, padded

AS_OF = "2026-01-15"

PART_RULES = [
    Rule("p_brand", pattern="Brand#[1-9]", min_length=7, max_length=7),
    Rule("p_type", enum=("ECONOMY", "LARGE", "MEDIUM", "SMALL", "STANDARD")),
    Rule("p_size", required=True, pattern="[0-9]{2}"),
    Rule("p_name", pattern="[a-z]+ (ring|rod|bolt)"),
    Rule("p_retailprice", max_length=5),
]
CUSTOMER_RULES = [
    Rule("c_mktsegment", enum=("AUTOMOBILE", "FURNITURE", "HOUSEHOLD", "MACHINERY"), required=True),
    Rule("c_name", pattern="Customer#[0-9]{9}", max_length=18),
    Rule("c_nationkey", enum=()),
    Rule("c_acctbal", pattern="[0-9]+\\.[0-9]+"),
]
DOCUMENT_RULES = [
    Rule("text", min_length=100, max_length=5000, required=True, pattern="(?s)[A-Z].*"),
    Rule("lang", pattern="[a-z]{2}", enum=("de", "en", "fr")),
    Rule("n_chars", max_length=3),
]
LABEL_RULES = [Rule("quality", enum=("1",)), Rule("toxic", enum=("0", "1"))]
EVENT_RULES = [
    Rule("event_type", enum=("click", "purchase", "signup", "view"), min_length=5),
    Rule("props", pattern='\\{"k": [0-9]\\}', max_length=10),
    Rule("value", pattern="[0-9]+\\.[0-9]{2}"),
    Rule("user_id", max_length=2, required=True),
]
TURN_RULES = [Rule("role", enum=("assistant", "user")), Rule("text", min_length=40, max_length=2000)]

CLAIMS = [
    ("region", "5"), ("nation", "25"), ("customer", "1.5K"), ("supplier", "100"), ("part", "2,000"),
    ("orders", "15K"), ("lineitem", "60.0K"), ("events", "1M"), ("documents", "about a thousand"),
    ("embeddings", "500"), ("pages", "0.2K"), ("labels", "0.40K"), ("warehouse", "12"),
]


def _read(function: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return function(Inputs(session.configure(spark), folder))

    query.__name__ = function.__name__
    query.__doc__ = function.__doc__
    return query


# Loads


def load_register(i: Inputs) -> DataFrame:
    """The register written as the CSV files it is published as, and loaded from them."""
    path = session.scratch_path(i.spark, "register")
    i.raw_register().write.option("header", True).option("escape", '"').csv(path)
    raw = readers.read_text_table(i.spark, f"{path}/*.csv", multiline=True)
    return loads.with_corpus(loads.load_register(raw), "legal_name", "city", "country")


def slice_dates(i: Inputs) -> DataFrame:
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    written = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("19x"), stamp))
        .when(F.col("o_orderpriority") == "2-HIGH", F.substring(stamp, 1, 4))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.replace(stamp, F.lit("-0"), F.lit("-3")))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(""))
        .otherwise(F.concat(stamp, F.lit(".000Z")))
    )
    return i.table("orders").select("o_orderkey", written.alias("written"), loads.calendar_date(written).alias("day"))


def flatten_positional(i: Inputs) -> DataFrame:
    """Each customer as a positional document; the order of its columns varies."""
    cells = {"cik": padded("c_custkey"), "name": F.col("c_name"), "ticker": F.upper(F.substring("c_mktsegment", 1, 4)),
             "exchange": F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("X"), F.col("c_nationkey").cast("string")))}

    def packed(order: list[str]):
        header = F.lit('{"fields":["' + '","'.join(order) + '"],"data":[[')
        body = F.concat_ws(",", *[
            F.when(cells[c].isNull(), F.lit("null")).otherwise(F.concat(F.lit('"'), cells[c], F.lit('"'))) for c in order
        ])
        return F.concat(header, body, F.lit("]]}"))

    document = F.when(F.col("c_mktsegment") == "BUILDING", packed(["ticker", "cik", "exchange", "name"])).otherwise(
        packed(["cik", "name", "ticker", "exchange"])
    )
    parsed = i.table("customer").select(F.inline(F.array(F.from_json(document, readers.POSITIONAL))))
    rows = readers.unpack_positional(
        parsed, {"cik": "cik", "company_name": "name", "ticker": "ticker", "exchange": "exchange"}
    )
    return loads.with_corpus(rows.withColumn("cik", identifiers.unpad(F.col("cik"))), "company_name", "ticker", "exchange")


def union_by_name_scan(i: Inputs) -> DataFrame:
    """Orders written as three releases whose columns differ, read back as one table."""
    base = session.scratch_path(i.spark, "releases")
    releases = {
        "F": ["o_orderkey", "o_custkey", "o_orderpriority"],
        "O": ["o_custkey", "o_orderpriority", "o_orderkey"],
        "P": ["o_orderpriority", "o_orderkey"],
    }
    for status, columns in releases.items():
        i.table("orders").where(F.col("o_orderstatus") == status).select(*columns).coalesce(4).write.option(
            "header", True
        ).option("sep", "\t").csv(f"{base}/{status}")
    return readers.read_union_by_name(i.spark, f"{base}/*/*.csv")


def parse_trailing_key(i: Inputs) -> DataFrame:
    key = padded("p_partkey")
    line = (
        F.when(F.col("p_type") == "PROMO", F.concat("p_name", F.lit(": "), "p_brand", F.lit(":"), key, F.lit(":")))
        .when(F.col("p_type") == "SMALL", F.concat("p_name", F.lit(":"), F.col("p_partkey").cast("string"), F.lit(":")))
        .when(F.col("p_type") == "LARGE", F.concat(F.lit(":"), key, F.lit(":")))
        .otherwise(F.concat("p_name", F.lit(":"), key, F.lit(":")))
    )
    return loads.parse_name_lines(i.table("part").select(line.alias("line")))


def derive_level(i: Inputs) -> DataFrame:
    digits = F.col("n_chars").cast("string")
    raw = i.table("documents").select(
        "doc_id",
        F.when(F.col("lang") == "de", F.concat_ws("-", F.substring(digits, 1, 2), F.lit("99"))).otherwise(digits).alias("code"),
        F.concat(F.lit(" "), "source", F.when(F.col("lang") == "fr", "T ").otherwise("T1")).alias("title"),
        F.when(F.col("lang") == "es", F.lit(" NULL ")).otherwise(F.col("text")).alias("description"),
    )
    return loads.with_corpus(loads.load_taxonomy(raw), "title", "description")


def type_registrations(i: Inputs) -> DataFrame:
    return loads.type_registrations(i.raw_registrations())


def normalise_id(i: Inputs) -> DataFrame:
    spaced = F.concat(F.lit(" "), padded("c_custkey"), F.lit("  "))
    return i.table("customer").select(
        "c_custkey",
        identifiers.unpad(spaced).alias("unpadded"),
        identifiers.tidy_id(F.concat(F.lit(" "), F.lower("c_name"), F.lit(" "))).alias("tidy"),
    )


def lei_mod97(i: Inputs) -> DataFrame:
    """Remainders of good, wrong, mistyped and malformed identifiers."""
    lei = F.col("lei")
    typed = (
        F.when(F.col("c_mktsegment") == "BUILDING", F.replace(lei, F.lit("0"), F.lit("O")))
        .when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit(" "), F.lower(lei)))
        .when(F.col("c_acctbal") < 0, F.concat(F.substring(lei, 1, 5), F.lit("-"), F.substring(lei, 7, 14)))
        .otherwise(lei)
    )
    rows = i.customers().withColumn("typed", typed)
    return rows.select(
        "c_custkey", "typed", identifiers.mod97(F.col("typed")).alias("remainder"),
        identifiers.check_digits_hold(F.col("typed")).alias("holds"),
    )


def search_corpus(i: Inputs) -> DataFrame:
    return loads.with_corpus(i.table("documents"), "text", "lang", "source").select("doc_id", "corpus")


# Edges


def entity_universe(i: Inputs) -> DataFrame:
    line = F.concat("c_name", F.lit(": "), "c_mktsegment", F.lit(":"), padded("c_custkey"), F.lit(":"))
    names = loads.parse_name_lines(i.table("customer").select(line.alias("line")))
    tickers = i.table("orders").where(F.col("o_orderstatus") == "F").select(
        F.col("o_custkey").alias("cik"), F.col("o_orderpriority").alias("ticker"), F.col("o_orderstatus").alias("exchange")
    )
    return loads.entity_universe(names, tickers)


def distinct_listagg(i: Inputs) -> DataFrame:
    named = i.table("part").select(
        F.col("p_type").alias("cik"), F.col("p_brand").alias("ticker"), F.col("p_name").alias("company_name")
    )
    return edges.one_row_per_filer(named)


def dedup_best(i: Inputs) -> DataFrame:
    return edges.best_per_key(
        i.table("orders"), ["o_custkey"], [("o_totalprice", True), ("o_orderkey", False)],
        ["o_orderkey", "o_totalprice", "o_orderstatus"],
    )


def dedup_edges(i: Inputs) -> DataFrame:
    claims = i.table("lineitem").select(
        F.lit("cik").alias("key_type"),
        F.col("l_partkey").cast("string").alias("key"),
        F.col("l_suppkey").cast("string").alias("lei"),
        F.when(F.col("l_returnflag") != "A", F.col("l_linestatus")).alias("category"),
        F.when(F.col("l_returnflag") == "R", edges.REGISTRATION).otherwise(edges.FILING).alias("method"),
        F.lit(edges.AUTHORITATIVE).alias("tier"),
        F.lit(1.0).alias("confidence"),
    )
    return edges.dedup_edges(claims)


def admit_identifiers(i: Inputs) -> DataFrame:
    return edges.admit_identifiers(i.filings(), i.register())


def _tiered(i: Inputs) -> DataFrame:
    return edges.tier_edges(
        loads.type_registrations(i.raw_registrations()),
        edges.admit_identifiers(i.filings(), i.register()),
        edges.admit_identifiers(i.filed_series(), i.register()),
        i.resolved(),
    )


def tier_edges(i: Inputs) -> DataFrame:
    return _tiered(i)


def enrich_edges(i: Inputs) -> DataFrame:
    return edges.enrich_edges(_tiered(i), i.register(), i.universe(), AS_OF)


def identifier_gate(i: Inputs) -> DataFrame:
    """What the gate finds where filings reach it without having been admitted first."""
    raw = i.filings().where(F.col("lei") != "").select("key", identifiers.tidy_id(F.col("lei")).alias("lei"))
    return edges.gate_report(raw, i.register())


def excluded_keys(i: Inputs) -> DataFrame:
    """Filers and series that reported something, and have no admitted claim."""
    ciks = i.filings().select(F.lit("cik").alias("key_type"), "key")
    series = i.filed_series().select(F.lit("series").alias("key_type"), "key")
    admitted = edges.admit_identifiers(i.filings(), i.register()).select(F.lit("cik").alias("key_type"), "key")
    listed = loads.type_registrations(i.raw_registrations()).where(F.col("key_type") == "series")
    return edges.excluded_keys([ciks, series], admitted.unionByName(listed.select("key_type", "key")))


# Linkage


def block_pairs(i: Inputs) -> DataFrame:
    return linkage.block_pairs(linkage.named(i.filers()), linkage.named(i.entities()))


def link_scores(i: Inputs) -> DataFrame:
    return linkage.link_scores(linkage.named(i.filers()), linkage.named(i.entities()))


def resolve_entities(i: Inputs) -> DataFrame:
    return linkage.resolve_entities(linkage.named(i.filers()), linkage.named(i.entities()))


def crosswalk(i: Inputs) -> DataFrame:
    """The whole build: load, admit, resolve, tier, enrich."""
    return build_crosswalk(
        registrations=i.raw_registrations(),
        filed_ciks=i.filings(),
        filed_series=i.filed_series(),
        register=i.register(),
        universe=i.universe(),
        filers=i.filers(),
        entities=i.entities(),
        as_of=AS_OF,
    )


def estimate_model(i: Inputs) -> DataFrame:
    """Shares and weights of agreement levels, as the names themselves teach them."""
    model, _ = estimation.learned(linkage.named(i.filers()), linkage.named(i.entities()))
    return estimation.model_table(i.spark, model)


def estimated_links(i: Inputs) -> DataFrame:
    return estimation.estimated_links(linkage.named(i.filers()), linkage.named(i.entities()))


def published_crosswalk(i: Inputs) -> DataFrame:
    """The edges that pass the gate, published in order and read back by the manifest."""
    built = session.staged(edges.enrich_edges(_tiered(i), i.register(), i.universe(), AS_OF), "edges")
    passing, _ = edges.split_edges(built, i.register())
    folder = session.scratch_path(i.spark, "crosswalk")
    publish_crosswalk(passing, i.register(), folder)
    return publish.read_published(i.spark, folder).select(*ORDER, "method", "tier", "rank")


# Contracts


def contract_fields(i: Inputs) -> DataFrame:
    fields = descriptors.contract_fields(i.descriptors())
    return fields.withColumn("enum", F.array_join("enum", "|"))


def contract_keys(i: Inputs) -> DataFrame:
    return descriptors.contract_keys(i.descriptors()).withColumn("columns", F.array_join("columns", "|"))


def resource_index(i: Inputs) -> DataFrame:
    return descriptors.resource_index(descriptors.contract_resources(i.descriptors()))


def check_field_set(i: Inputs) -> DataFrame:
    return contract.check_field_set(descriptors.contract_fields(i.descriptors()), i.published_columns())


def check_types(i: Inputs) -> DataFrame:
    return contract.check_types(descriptors.contract_fields(i.descriptors()), i.published_columns())


def check_foreign_keys(i: Inputs) -> DataFrame:
    d = i.descriptors()
    return contract.check_foreign_keys(
        descriptors.contract_foreign_keys(d), descriptors.contract_fields(d), descriptors.contract_resources(d)
    )


def check_constraints(i: Inputs) -> DataFrame:
    rules = {"part": PART_RULES, "customer": CUSTOMER_RULES, "documents": DOCUMENT_RULES, "labels": LABEL_RULES}
    return contract.union_all(contract.check_constraints(i.table(t), r, "shop", t) for t, r in rules.items())


KEYS = {
    "lineitem": ["l_orderkey", "l_linenumber"], "documents": ["doc_id"], "orders": ["o_custkey"],
    "events": ["user_id", "event_type"], "conversations": ["conv_id", "turn"],
}


def key_scan(i: Inputs) -> DataFrame:
    """Declared keys, and one that is missing where documents have no label."""
    scans = [
        contract.key_scan(i.table(t), c).select(F.lit(t).alias("resource"), F.lit(",".join(c)).alias("columns"), "*")
        for t, c in KEYS.items()
    ]
    labelled = i.table("documents").join(i.table("labels"), "doc_id", "left")
    scans.append(
        contract.key_scan(labelled, ["lang", "quality"]).select(
            F.lit("labelled").alias("resource"), F.lit("lang,quality").alias("columns"), "*"
        )
    )
    return contract.union_all(scans)


def check_primary_key(i: Inputs) -> DataFrame:
    return contract.union_all(contract.check_primary_key(i.table(t), c, "shop", t) for t, c in KEYS.items())


def drift_contract(i: Inputs) -> DataFrame:
    rules = {"customer": CUSTOMER_RULES, "events": EVENT_RULES, "conversations": TURN_RULES}
    return contract.union_all(
        contract.check_drift(i.table(t), r).select(F.lit(t).alias("resource"), "*") for t, r in rules.items()
    )


# Coverage


def join_coverage(i: Inputs) -> DataFrame:
    docs, labels, lines, parts = (i.table(t) for t in ("documents", "labels", "lineitem", "part"))
    joins = [
        (docs, labels, Join("labels", ("doc_id",), "labels", ("doc_id",), coverage=(1000, 399))),
        (docs, labels, Join("english", ("doc_id",), "labels", ("doc_id",), where=("lang", "en"), coverage=(620, 1))),
        (lines, parts, Join("parts", ("l_partkey",), "part", ("p_partkey",), coverage=(60000, 60000))),
        (lines, i.table("orders"),
         Join("orders", ("l_orderkey", "l_suppkey"), "orders", ("o_orderkey", "o_custkey"), coverage=(60000, 0))),
    ]
    return contract.union_all(coverage.check_coverage(coverage.join_coverage(a, b, j), j) for a, b, j in joins)


def _typed_keys(i: Inputs) -> DataFrame:
    """Keys of two schemes in one text column."""
    ciks = i.table("orders").select(F.lit("cik").alias("key_type"), F.col("o_custkey").cast("string").alias("key"))
    series = i.table("lineitem").select(
        F.lit("series").alias("key_type"), F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("key")
    )
    return ciks.unionByName(series)


def join_coverage_text(i: Inputs) -> DataFrame:
    known = i.table("customer").where("c_acctbal >= 0")
    scoped = Join("filers", ("key",), "customer", ("c_custkey",), "text", ("key_type", "cik"))
    whole = Join("everything", ("key",), "customer", ("c_custkey",), "text")
    return contract.union_all(coverage.join_coverage(_typed_keys(i), known, j) for j in (scoped, whole))


def join_sample(i: Inputs) -> DataFrame:
    join = Join("filers", ("key",), "customer", ("c_custkey",), "text", ("key_type", "cik"))
    return coverage.join_sample(_typed_keys(i), i.table("customer").where("c_acctbal >= 0"), join, 20)


def plan_joins(i: Inputs) -> DataFrame:
    """Every part's declared join: the tables it would run on, or what is wrong with it."""
    return joins.plan_joins(i.joining_descriptors()).select(*joins.PLANNED, "finding")


def _resource(name: str, *fields: str) -> dict:
    return {"name": name, "path": f"{name}.parquet", "schema": {"fields": [{"name": f} for f in fields]}}


def _join(name: str, fields, resource: str, theirs, rows: int, matched: int, **more) -> dict:
    reference = {"resource": resource, "fields": theirs}
    return {"name": name, "fields": fields, "reference": reference, "coverage": {"rows": rows, "matched": matched}, **more}


JOINED = [
    {
        "name": "sales",
        "resources": [
            _resource("orders", "o_orderkey", "o_custkey", "o_orderstatus"),
            _resource("lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_returnflag"),
        ],
        "x-joins": {"joins": [
            _join("buyers", "o_custkey", "customer", "c_custkey", 15000, 15000),
            _join("pending", ["o_custkey"], "labels", ["doc_id"], 1, 0, compareAs="text", where={"field": "o_orderstatus", "equals": "P"}),
            _join("own lines", ["l_orderkey", "l_suppkey"], "orders", ["o_orderkey", "o_custkey"], 60000, 12),
            _join("returned parts", "l_partkey", "part", "p_partkey", 20000, 20000, where={"field": "l_returnflag", "equals": "R"}),
        ]},
    },
    {"name": "parties", "resources": [_resource("customer", "c_custkey", "c_name"), _resource("part", "p_partkey", "p_name")]},
    {
        "name": "texts",
        "resources": [_resource("documents", "doc_id", "lang"), _resource("labels", "doc_id", "toxic")],
        "x-joins": {"joins": [
            _join("judged", "doc_id", "judgements", "doc_id", 1000, 399, where={"field": "lang", "equals": "en"}),
            _join("english", ["lang"], "customer", ["c_custkey"], 1000, 0),
        ]},
    },
    {"name": "quality", "resources": [_resource("judgements", "doc_id", "quality")]},
]


def declared_joins(i: Inputs) -> DataFrame:
    """Joins that packages declare, checked; then written as measured, and checked again.

    Labels are redirected to those that no one has published yet, the good ones."""
    tables = {(p["name"], r["name"]): i.table("labels" if r["name"] == "judgements" else r["name"]) for p in JOINED for r in p["resources"]}
    local = {"labels": i.table("labels").where("quality = 1")}

    def run(documents: list[dict], write: bool) -> DataFrame:
        plan = joins.plan_joins(joins.documents_frame(i.spark, documents), write)
        return session.staged(joins.run_joins(plan, tables, local), "measured")

    checked = run(JOINED, False)
    again = run([joins.with_coverage(d, checked) for d in JOINED], False)
    return checked.withColumn("mode", F.lit("check")).unionByName(again.withColumn("mode", F.lit("written")))


# Profiles


def profile_columns(i: Inputs) -> DataFrame:
    return contract.union_all(
        profile.profile_columns(i.table(t)).select(F.lit(t).alias("resource"), "*")
        for t in ("customer", "part", "lineitem")
    )


ENUMS = {"o_orderstatus": ["F", "O", "P", "X"], "o_orderpriority": ["1-URGENT", "2-HIGH"]}


def describe_columns(i: Inputs) -> DataFrame:
    """Formats and domains of orders, documents and events; lists are shown as JSON, so no value runs into the next."""
    told = [
        profile.describe_columns(i.table(t), enums).select(F.lit(t).alias("resource"), "*")
        for t, enums in (("orders", ENUMS), ("documents", None), ("events", {"event_type": ["click"]}))
    ]
    lists = {c: F.to_json(c) for c in ("domain", "outside", "unseen")}
    return contract.union_all(told).withColumns(lists)


OVERRIDES = [
    ("c_custkey", "string", "the customer's number", "[0-9]+", 1, 12, True),
    ("c_mktsegment", None, "trade", None, None, 20, None),
]


def overlay_descriptor(i: Inputs) -> DataFrame:
    customer = i.table("customer")
    profile.check_curated_keys(customer, ["c_custkey"])
    schema = ("column string, type string, description string, pattern string, "
              "min_length int, max_length int, required boolean")
    overrides = i.spark.createDataFrame(OVERRIDES, schema)
    return profile.overlay_descriptor(profile.profile_columns(customer), overrides)


# Catalogue, objects, runs


def _catalogue(i: Inputs) -> DataFrame:
    claims = i.spark.createDataFrame(CLAIMS, "dataset string, stated string")
    return catalogue.check_catalogue(claims, catalogue.count_rows({t: i.table(t) for t in TABLES}))


def catalogue_counts(i: Inputs) -> DataFrame:
    return _catalogue(i)


def object_inventory(i: Inputs) -> DataFrame:
    found = objects.object_inventory(i.spark, f"{i.folder}/*.parquet")
    return found.select(F.regexp_extract("path", r"([^/]+)\z", 1).alias("object"), "bytes", "hash")


def verify_objects(i: Inputs) -> DataFrame:
    """Documents as objects: their stated sizes count letters, and some digests are stale."""
    docs = i.table("documents").withColumn("object", F.col("doc_id").cast("string"))
    declared = docs.select(
        "object",
        F.col("n_chars").alias("bytes"),
        F.concat(F.lit("sha256:"), F.sha2(F.when(F.col("lang") == "de", F.trim("text")).otherwise(
            F.regexp_replace("text", "e", "E")), 256)).alias("hash"),
    )
    measured = objects.text_inventory(docs.where("source != 'src7'"), "object", "text")
    return inventory.verify_objects(declared, measured)


def content_digest(i: Inputs) -> DataFrame:
    """Tables before and after they are rewritten in another order."""
    checks = []
    for name, order in {"lineitem": ["l_orderkey", "l_linenumber", "l_partkey"], "documents": ["doc_id"]}.items():
        path = session.scratch_path(i.spark, name)
        export.export_ordered(i.table(name), path, order, 10_000)
        before = inventory.content_digest(i.table(name), name)
        checks.append(inventory.unchanged(before, inventory.content_digest(i.spark.read.parquet(path), name)))
    return contract.union_all(checks)


def content_changed(i: Inputs) -> DataFrame:
    """Tables against copies that are not the same: a row twice, a row lost, a value changed, columns in another order."""
    checks = []
    for name, change in {
        "nation": lambda t: t.unionByName(t.where("n_nationkey = 3")),
        "supplier": lambda t: t.where("s_suppkey <> 7"),
        "customer": lambda t: t.withColumn("c_acctbal", F.when(F.col("c_custkey") == 5, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))),
        "part": lambda t: t.select(*reversed(t.columns)),
    }.items():
        table = i.table(name)
        before, after = inventory.content_digest(table, name), inventory.content_digest(change(table).select(*table.columns), name)
        checks.append(inventory.unchanged(before, after))
    return contract.union_all(checks)


def total_order_export(i: Inputs) -> DataFrame:
    order = ["o_orderpriority", "o_orderdate", "o_orderkey"]
    path = session.scratch_path(i.spark, "orders")
    export.export_ordered(i.table("orders"), path, order, 50_000)
    return export.order_report(i.spark, path, order).select("rows", "out_of_order", "overlapping_files")


def total_order_rank(i: Inputs) -> DataFrame:
    """Where each order lies in the exported files."""
    path = session.scratch_path(i.spark, "ranked")
    export.export_ordered(i.table("orders"), path, ["o_orderpriority", "o_orderdate", "o_orderkey"], 50_000)
    return export.ranked_rows(i.spark, path).select("o_orderkey", "rank")


def parquet_layout(i: Inputs) -> DataFrame:
    path = session.scratch_path(i.spark, "layout")
    export.export_ordered(i.table("lineitem"), path, ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"], 1_000)
    layout = objects.parquet_layout(objects.parquet_row_groups(i.spark, f"{path}/*.parquet"))
    return layout.select("rows", "widest_row_group", "codec")


def _description(i: Inputs) -> dict:
    types = {"c_custkey": "string", "c_name": "string", "c_nationkey": "integer", "c_acctbal": "number", "c_phone": "string"}
    return {
        "name": "shop",
        "resources": [
            {
                "name": "customer", "bytes": 12, "hash": "sha256:00",
                "schema": {"fields": [{"name": n, "type": t} for n, t in types.items()], "primaryKey": ["c_nationkey"]},
            }
        ],
    }


def self_description(i: Inputs) -> DataFrame:
    """A table written with a description that is not all true, held to a kept copy of it."""
    path = session.scratch_path(i.spark, "described")
    described = _description(i)
    export.with_description(i.table("customer"), described).write.parquet(path)
    kept = {**described, "title": "Customers"}
    return export.check_self_description(i.spark.read.parquet(path), kept, "shop", "customer", require=True)


def run_provenance(i: Inputs) -> DataFrame:
    return provenance.run_provenance(i.runs(), i.run_objects(), "datapackage.json")


def run_errors(i: Inputs) -> DataFrame:
    """Records that the reader refuses, and why."""
    return i.runs().where(F.col("error").isNotNull()).select("source", "error")


def run_reasons(i: Inputs) -> DataFrame:
    """Every run that claims an object, and why it does not license it."""
    told = provenance.claimant_reasons(i.runs(), i.run_objects(), "datapackage.json")
    return told.select("object", "run_id", "rung", "reason")


def run_refusals(i: Inputs) -> DataFrame:
    """Each object's answer, with all the reasons its runs give."""
    told = provenance.claimant_reasons(i.runs(), i.run_objects(), "datapackage.json")
    return provenance.refusals(told)


def address_history(i: Inputs) -> DataFrame:
    return registry.address_history(i.registry_states())


def history_violations(i: Inputs) -> DataFrame:
    return registry.history_violations(i.registry_states())


def registry_invariants(i: Inputs) -> DataFrame:
    return registry.registry_invariants(i.registry())


def document_diff(i: Inputs) -> DataFrame:
    kept, carried = i.document_pairs()
    return documents.document_diff(kept, carried, "o_orderkey", "body")


def violation_report(i: Inputs) -> DataFrame:
    """Every check's findings as one list, totalled by resource and rule.

    Each check is a job of its own, whose totals are staged: the driver holds the plan of one check at a time, not of all.
    """
    findings = {
        "field_set": check_field_set(i), "types": check_types(i), "foreign_keys": check_foreign_keys(i),
        "constraints": check_constraints(i), "primary_key": check_primary_key(i),
        "catalogue": catalogue.catalogue_violations(_catalogue(i), "catalogue"),
    }
    counted = [session.staged(contract.count_findings(f), f"findings-{name}") for name, f in findings.items()]
    return contract.add_findings(contract.union_all(counted))


REGISTERED = [
    load_register, slice_dates, flatten_positional, union_by_name_scan, parse_trailing_key, derive_level,
    type_registrations, normalise_id, lei_mod97, search_corpus, entity_universe, distinct_listagg, dedup_best,
    dedup_edges, admit_identifiers, tier_edges, enrich_edges, identifier_gate, excluded_keys, block_pairs,
    link_scores, resolve_entities, crosswalk, contract_fields, contract_keys, resource_index, check_field_set,
    check_types, check_foreign_keys, check_constraints, key_scan, check_primary_key, drift_contract, join_coverage,
    join_coverage_text, join_sample, profile_columns, overlay_descriptor, catalogue_counts, object_inventory,
    verify_objects, content_digest, total_order_export, parquet_layout, self_description, run_provenance, run_errors,
    registry_invariants, document_diff, violation_report, estimate_model, estimated_links, plan_joins, declared_joins,
    total_order_rank, published_crosswalk, run_reasons, run_refusals, address_history, history_violations, describe_columns,
    content_changed,
]


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {function.__name__: _read(function) for function in REGISTERED}
