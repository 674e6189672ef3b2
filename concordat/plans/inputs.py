"""The sources that the registered queries read, derived by Spark from the given tables.

Customers stand in for legal entities, orders for annual filings and run records, parts
for published packages, documents and pages for named entities. Faults come from the
tables' own attributes, so they grow with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identifiers import with_check_digits
from ..sources.descriptors import parse_descriptors
from ..sources.runs import parse_runs

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
PLACEHOLDER = "0" * 20


class Inputs:
    """Tables of one folder, and what is derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # Identifiers and register

    def customers(self) -> DataFrame:
        """Customers with an identifier; those in furniture carry wrong check digits."""
        good = identifier("c_custkey")
        wrong = F.concat(
            F.substring(good, 1, 18), F.lpad((F.substring(good, 19, 2).cast("int") + 1).cast("string"), 2, "0")
        )
        return self.table("customer").withColumn(
            "lei", F.when(F.col("c_mktsegment") == "FURNITURE", wrong).otherwise(good)
        )

    def raw_register(self) -> DataFrame:
        """A register export under its own dotted column names, every column text."""
        nation = self.table("nation")
        region = self.table("region")
        balance = F.col("c_acctbal")
        started = F.concat(
            F.lit("20"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.lit("-"),
            F.lpad((F.floor(F.abs(balance) / 700) + 1).cast("string"), 2, "0"), F.lit("-15T08:30:00.000Z"),
        )
        return (
            self.customers()
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("lei").alias("LEI"),
                F.concat_ws(" ", "c_name", F.lit("Société"), "n_name").alias("Entity.LegalName"),
                F.col("n_name").alias("Entity.LegalAddress.Country"),
                F.when(balance >= 0, F.initcap("c_mktsegment")).alias("Entity.LegalAddress.City"),
                F.col("r_name").alias("Entity.LegalJurisdiction"),
                F.concat(F.lit("F"), F.lpad(F.col("c_nationkey").cast("string"), 3, "0")).alias(
                    "Entity.LegalForm.EntityLegalFormCode"
                ),
                F.when(balance < 0, "NULL").when(balance < 5000, "INACTIVE").otherwise("ACTIVE").alias(
                    "Entity.EntityStatus"
                ),
                F.when(balance < 2000, "LAPSED").when(balance < 4000, "RETIRED").otherwise("ISSUED").alias(
                    "Registration.RegistrationStatus"
                ),
                started.alias("Registration.InitialRegistrationDate"),
                F.when(F.col("c_mktsegment") == "MACHINERY", "").otherwise(started).alias(
                    "Registration.NextRenewalDate"
                ),
            )
        )

    def register(self) -> DataFrame:
        """What the register publishes: customers with a balance that is not negative."""
        names = self.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        return (
            self.customers()
            .where("c_acctbal >= 0")
            .join(names, "c_nationkey")
            .select(
                "lei",
                F.concat_ws(" ", "c_name", F.lit("Société")).alias("legal_name"),
                F.col("n_name").alias("jurisdiction"),
                F.when(F.col("c_acctbal") < 5000, "LAPSED").otherwise("ISSUED").alias("registration_status"),
            )
        )

    def filings(self) -> DataFrame:
        """One filing per order: a padded key and an identifier as its filer typed it.

        Pending orders, a third of all, carry the same placeholder.
        """
        lei = F.col("lei")
        typed = (
            F.when(F.col("o_orderstatus") == "P", PLACEHOLDER)
            .when(F.col("o_orderpriority") == "5-LOW", F.replace(lei, F.lit("0"), F.lit("O")))
            .when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("  "), F.lower(lei), F.lit(" ")))
            .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit(""))
            .otherwise(lei)
        )
        ids = self.customers().select(F.col("c_custkey").alias("o_custkey"), "lei")
        return (
            self.table("orders")
            .join(ids, "o_custkey")
            .select(padded("o_custkey").alias("cik"), F.col("o_custkey").cast("string").alias("key"), typed.alias("lei"))
        )

    def raw_registrations(self) -> DataFrame:
        """Registrations under four kinds of number, some of them blank or of no use."""
        category = (
            F.when(F.col("c_mktsegment") == "BUILDING", "FUND")
            .when(F.col("c_mktsegment") == "MACHINERY", "GENERAL")
            .otherwise(F.lit(None))
        )
        number = F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(padded("c_custkey"))
        filers = self.customers().where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "FURNITURE"))
        parts = [
            filers.select(F.lower("lei").alias("lei"), number.alias("registered_as"), category.alias("category")),
            self.table("supplier").select(
                identifier("s_suppkey").alias("lei"),
                F.concat(F.lit("S"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0")).alias("registered_as"),
                F.lit("FUND").alias("category"),
            ),
            self.table("part").select(
                identifier("p_partkey").alias("lei"),
                F.concat(F.lit("C"), F.lpad(F.col("p_partkey").cast("string"), 9, "0"), F.lit(" ")).alias("registered_as"),
                F.when(F.col("p_type") == "PROMO", F.lit(None)).otherwise("GENERAL").alias("category"),
            ),
            self.table("orders").select(
                identifier("o_custkey").alias("lei"),
                F.concat(F.lit("805-"), F.col("o_orderkey").cast("string")).alias("registered_as"),
                F.lit("GENERAL").alias("category"),
            ),
        ]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def filed_series(self) -> DataFrame:
        """Series filings: a supplier per line item, whose identifier it repeats."""
        ids = self.table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), identifier("s_suppkey").alias("lei"))
        return (
            self.table("lineitem")
            .join(ids, "l_suppkey")
            .select(
                F.concat(F.lit("S"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")).alias("key"),
                F.when(F.col("l_returnflag") == "R", PLACEHOLDER).otherwise(F.col("lei")).alias("lei"),
            )
        )

    def resolved(self) -> DataFrame:
        """Name matches as a resolver reports them, one per order."""
        return self.table("orders").select(
            padded("o_custkey").alias("cik"),
            F.lower(identifier("o_custkey")).alias("lei"),
            F.when(F.col("o_orderstatus") == "F", "exact_name").otherwise("jaro_winkler").alias("method"),
            F.when(F.col("o_orderpriority") == "1-URGENT", "confirmed")
            .when(F.col("o_orderpriority") == "2-HIGH", "candidate")
            .when(F.col("o_orderpriority") == "3-MEDIUM", "ambiguous")
            .otherwise("rejected")
            .alias("status"),
            (F.floor("o_totalprice") / 1e6).alias("match_probability"),
        )

    def universe(self) -> DataFrame:
        """Filers under the names and tickers of each of their orders."""
        return self.table("orders").select(
            F.col("o_custkey").cast("string").alias("cik"),
            F.concat_ws(" ", F.lit("Filer"), "o_custkey", "o_orderpriority").alias("company_name"),
            F.when(F.col("o_orderpriority") != "5-LOW", F.concat_ws("-", "o_orderstatus", F.substring("o_orderpriority", 1, 1))).alias("ticker"),
            F.col("o_orderpriority").alias("exchange"),
        )

    # Named entities

    def filers(self) -> DataFrame:
        """Documents by their heading line."""
        return self.table("documents").select(
            F.col("doc_id").cast("string").alias("id"),
            F.substring_index("text", "\n", 1).alias("name"),
            F.col("lang").alias("country"),
        )

    def entities(self) -> DataFrame:
        """Pages by their title element; the address says how current they are."""
        host = F.regexp_extract("url", r"^https?://([^/?#]+)", 1)
        return self.table("pages").select(
            F.col("page_id").cast("string").alias("id"),
            F.regexp_extract("html", r"<title>([^<]*)</title>", 1).alias("name"),
            F.regexp_extract("html", r'<html lang="([a-z]+)"', 1).alias("country"),
            F.when(host.endswith(".com"), "ISSUED").when(host.endswith(".net"), "LAPSED").otherwise("RETIRED").alias("status"),
            F.when(F.col("url").startswith("https:"), "US").otherwise("XX").alias("jurisdiction"),
        )

    # Packages, runs, registry

    def descriptors(self) -> DataFrame:
        """One package descriptor per part, parsed from the JSON text it is published as."""
        kind = F.col("p_type")
        key_type = (
            F.when(kind == "STANDARD", "string").when(kind == "ECONOMY", "integer").when(kind == "LARGE", "number")
            .when(kind == "MEDIUM", "date").when(kind == "PROMO", F.lit(None)).otherwise("money")
        )
        fields = F.concat(
            F.lit('[{"name":"key"'),
            F.coalesce(F.concat(F.lit(',"type":"'), key_type, F.lit('"')), F.lit("")),
            F.lit(',"constraints":{"required":true,"pattern":"^[A-Z]+$"}},'),
            F.lit('{"name":"brand","type":"string","constraints":{"minLength":1,"maxLength":'),
            F.col("p_size").cast("string"),
            F.lit("}},"),
            F.lit('{"name":"size","type":"integer","constraints":'),
            F.when(kind == "PROMO", F.lit('{"unique":true,"enum":[]}')).otherwise(F.lit('{"enum":["1","2",3]}')),
            F.lit("}]"),
        )
        primary = (
            F.when(kind == "LARGE", F.lit('["key","brand"]')).when(kind == "SMALL", F.lit("[]"))
            .when(kind == "MEDIUM", F.lit("7")).otherwise(F.lit('"key"'))
        )
        local = F.when(kind == "ECONOMY", F.lit('["key","size"]')).when(kind == "PROMO", F.lit('"colour"')).otherwise(F.lit('"key"'))
        target = F.concat_ws("_", F.replace("p_name", F.lit(" "), F.lit("_")), (51 - F.col("p_size")).cast("string"))
        text = F.concat(
            F.lit('{"name":"pkg'), F.col("p_partkey").cast("string"),
            F.lit('","resources":[{"name":"'), part_resource(),
            F.lit('","path":"data/'), F.col("p_partkey").cast("string"), F.lit('.parquet","bytes":'),
            (F.col("p_partkey") * 10).cast("string"),
            F.lit(',"schema":{"fields":'), fields, F.lit(',"primaryKey":'), primary,
            F.lit(',"foreignKeys":[{"fields":'), local, F.lit(',"reference":{"resource":"'), target,
            F.lit('","fields":["size"]}}]}}]}'),
        )
        return parse_descriptors(self.table("part").select(text.alias("text")), "text")

    def joining_descriptors(self) -> DataFrame:
        """One package per part that declares a join with another part's resource; what is wrong with it hangs on its type."""
        kind = F.col("p_type")
        key = F.lit('"key"')
        ours = F.when(kind == "ECONOMY", F.lit('["key","size"]')).when(kind == "PROMO", F.lit('"colour"')).otherwise(key)
        theirs = F.when(kind == "SMALL", F.lit('["weight"]')).otherwise(F.lit('["size"]'))
        compare = F.when(kind == "LARGE", F.lit('"compareAs":"fuzzy",')).when(kind == "STANDARD", F.lit('"compareAs":"text",')).otherwise(F.lit(""))
        scope = F.when(F.col("p_brand") == "Brand#11", F.lit('"where":{"field":"brand"},')).otherwise(
            F.lit('"where":{"field":"brand","equals":"x"},'))
        coverage = F.when(kind == "MEDIUM", F.lit('{"rows":3,"matched":5}')).otherwise(F.lit('{"matched":7,"rows":10}'))
        target = F.concat_ws("_", F.replace("p_name", F.lit(" "), F.lit("_")), (51 - F.col("p_size")).cast("string"))
        text = F.concat(
            F.lit('{"name":"pkg'), F.col("p_partkey").cast("string"), F.lit('","resources":[{"name":"'), part_resource(),
            F.lit('","schema":{"fields":[{"name":"key"},{"name":"brand"},{"name":"size"}]}}],"x-joins":{"joins":[{"name":"other","fields":'),
            ours, F.lit(',"reference":{"resource":"'), target, F.lit('","fields":'), theirs, F.lit("},"), compare, scope,
            F.lit('"coverage":'), coverage, F.lit("}]}}"),
        )
        return parse_descriptors(self.table("part").select(text.alias("text")), "text")

    def published_columns(self) -> DataFrame:
        """The columns each part's published file really has."""
        column = lambda name, physical: F.struct(F.lit(name).alias("field"), physical.alias("physical"))
        key = F.when(F.col("p_size") <= 25, "string").otherwise("bigint")
        brand = F.when(F.col("p_type") != "PROMO", F.lit("string"))
        legacy = F.when(F.col("p_type") == "SMALL", F.lit("double"))
        columns = F.array(
            column("key", key), column("brand", brand), column("size", F.lit("int")), column("legacy", legacy)
        )
        return (
            self.table("part")
            .select(
                F.concat(F.lit("pkg"), "p_partkey").alias("package"),
                part_resource().alias("resource"),
                F.inline(columns),
            )
            .where(F.col("physical").isNotNull())
        )

    def runs(self) -> DataFrame:
        """One run record per order, parsed from its JSON text."""
        priority = F.col("o_orderpriority")
        key = F.col("o_custkey").cast("string")
        artefact = F.sha2(F.concat(F.lit("artefact "), key), 256)
        described = F.sha2(F.concat(F.lit("descriptor "), key, F.when(priority == "4-NOT SPECIFIED", " old").otherwise("")), 256)
        version = F.when((priority == "5-LOW") & (F.col("o_orderstatus") == "F"), "b4/0").otherwise("b4/1")
        describe = (
            F.when(priority == "2-HIGH", F.lit('{"state":"skipped","skip_reason":null}'))
            .when(priority == "3-MEDIUM", F.lit('{"state":"skipped","skip_reason":"hash_clean"}'))
            .otherwise(F.lit('{"state":"success","skip_reason":null}'))
        )
        text = F.concat(
            F.lit('{"contract_version":"'), version, F.lit('","run":{"run_id":"run'), F.col("o_orderkey").cast("string"),
            F.lit('","started_at":"'), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit('","outcome":"'),
            F.when(F.col("o_orderstatus") == "P", "partial").otherwise("success"),
            F.lit('"},"assets":[{"kind":"file","path":"build/out.parquet","content_hash":"'), artefact,
            F.lit('","produced_by":"export"},{"kind":"file","path":"datapackage.json","content_hash":"sha256:'), described,
            F.lit('","produced_by":"describe"},{"kind":"file","path":"raw/*.csv","produced_by":null}],"steps":['),
            F.lit('{"name":"export","status":{"state":"success","skip_reason":null}},{"name":"describe","status":'), describe,
            F.when(F.col("o_orderstatus") == "P", F.lit('},{"name":"verify","status":{"state":"failed","skip_reason":null}')).otherwise(F.lit("")),
            F.lit("}]}"),
        )
        records = self.table("orders").select(
            text.alias("text"), F.concat(F.lit("runs/"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("path")
        )
        return parse_runs(records, "text", "path")

    def run_objects(self) -> DataFrame:
        key = F.col("c_custkey").cast("string")
        form = lambda what: F.concat(F.lit("sha256:"), F.sha2(F.concat(F.lit(what), key), 256))
        return self.table("customer").select(
            key.alias("object"), form("artefact ").alias("hash"), form("descriptor ").alias("descriptor_hash")
        )

    def registry(self) -> DataFrame:
        """Suppliers and customers as registered datasets; their ids overlap, as do old names."""
        suppliers = self.table("supplier").select(
            F.concat(F.lit("u"), "s_suppkey").alias("uid"),
            F.lit("source").alias("schema"),
            F.lower(F.replace("s_name", F.lit("#"), F.lit("_"))).alias("name"),
            F.array(F.concat(F.lit("old_"), "s_nationkey")).alias("aliases"),
        )
        customers = self.table("customer").select(
            F.concat(F.lit("u"), "c_custkey").alias("uid"),
            F.lit("crosswalk").alias("schema"),
            F.concat_ws("_", F.lower("c_mktsegment"), F.floor("c_acctbal").cast("string")).alias("name"),
            F.lit(None).cast("array<string>").alias("aliases"),
        )
        return suppliers.unionByName(customers)

    def registry_states(self) -> DataFrame:
        """Customers as datasets in three states of a registry, where some are renamed, lost, found again or pointed elsewhere.

        Names follow keys at first. In the second state machinery is renamed and keeps its old name as an alias, buildings are renamed and do
        not, and furniture is missing; in the third, households trade names with the key after theirs.
        """
        key, kind = F.col("c_custkey"), F.col("c_mktsegment")
        name = F.concat(F.lit("set"), key.cast("string"))
        later = F.when(kind.isin("MACHINERY", "BUILDING"), F.concat(F.lit("new"), key.cast("string"))).otherwise(name)
        traded = F.when(kind == "HOUSEHOLD", F.concat(F.lit("set"), (key + 1).cast("string"))).otherwise(later)
        kept = F.when(kind == "MACHINERY", F.array(name)).otherwise(F.array().cast("array<string>"))
        state = lambda version, name, aliases: F.struct(F.lit(version).alias("version"), name.alias("name"), aliases.alias("aliases"))
        none = F.array().cast("array<string>")
        states = F.array(state(1, name, none), state(2, later, kept), state(3, traded, kept))
        told = self.table("customer").select(F.concat(F.lit("u"), key.cast("string")).alias("uid"), kind.alias("kind"), F.inline(states))
        return told.where("not (version = 2 and kind = 'FURNITURE')").select("version", "uid", F.lit("source").alias("schema"), "name", "aliases")

    def document_pairs(self) -> tuple[DataFrame, DataFrame]:
        """Orders as JSON documents, as kept and as carried; they differ by priority."""
        key, status, priority = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
        kept = F.concat(
            F.lit('{"id":'), key.cast("string"), F.lit(',"status":"'), status, F.lit('","price":{"unit":"X","lines":[1,2]},"tags":["'),
            priority, F.lit('","'), status, F.lit('"]}'),
        )
        price = F.when(priority == "2-HIGH", "7").otherwise('{"lines":[1.0,2],"unit":"X"}')
        tags = (
            F.when(priority == "1-URGENT", F.lit('["a","b","c"]'))
            .otherwise(F.concat(F.lit('["'), priority, F.lit('","'), F.when(status == "P", "Q").otherwise(status), F.lit('"]')))
        )
        carried = F.concat(
            F.lit('{"tags":'), tags, F.lit(',"price":'), price,
            F.when(priority == "3-MEDIUM", F.lit("")).otherwise(F.concat(F.lit(',"status":"'), status, F.lit('"'))),
            F.when(priority == "4-NOT SPECIFIED", F.lit(',"note":{"by":["x"]}')).otherwise(F.lit("")),
            F.lit(',"id":'), key.cast("string"), F.lit(".0}"),
        )
        orders = self.table("orders")
        return (
            orders.select(key, kept.alias("body")),
            orders.select(key, carried.alias("body")),
        )


def padded(column: str) -> Column:
    return F.lpad(F.col(column).cast("string"), 10, "0")


def identifier(column: str) -> Column:
    """A twenty-character identifier with good check digits for a key."""
    return with_check_digits(F.concat(F.lit("529900Q"), F.lpad(F.col(column).cast("string"), 11, "0")))


def part_resource() -> Column:
    return F.concat_ws("_", F.replace("p_name", F.lit(" "), F.lit("_")), F.col("p_size").cast("string"))
