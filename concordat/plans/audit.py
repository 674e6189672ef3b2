"""Hold published packages to their descriptors, every finding in one list."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import catalogue, contract, export, joins
from ..sources import descriptors
from ..sources.readers import list_files


def locate(descriptor: str, path: str) -> str:
    """Where a resource lies; a relative path lies next to its descriptor."""
    return path if re.match(r"[a-z][a-z0-9+.-]*:/", path, re.IGNORECASE) else f"{descriptor.rsplit('/', 1)[0]}/{path}"


def check_bytes(spark: SparkSession, package: str, resource: dict, place: str) -> DataFrame:
    """The declared size against the files that are there."""
    files = place if place.endswith(".parquet") else f"{place}/*.parquet"
    measured = list_files(spark, files).agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))
    wrong = measured.where(F.col("bytes") != resource["bytes"]).select(
        F.lit(package).alias("package"), F.lit(resource["name"]).alias("resource"), F.lit("").alias("field"),
        F.lit("resource.bytes").alias("rule"), "bytes",
    )
    return contract.violations(wrong, f"declares {resource['bytes']:,} bytes; there are ", F.format_number("bytes", 0))


class Published(dict):
    """Tables by (package, resource), read when they are first asked for."""

    def __init__(self, spark: SparkSession, places: dict[tuple[str, str], str]):
        super().__init__()
        self.spark, self.places = spark, places

    def __missing__(self, key: tuple[str, str]) -> DataFrame:
        self[key] = table = self.spark.read.parquet(self.places[key])
        return table

    def __contains__(self, key: object) -> bool:
        return key in self.places


def read_documents(texts: DataFrame) -> list[tuple[str, dict]]:
    """(path, document) of each descriptor, in order; one that is no JSON object is an error."""
    documents = []
    for row in texts.orderBy("path").collect():
        try:
            document = json.loads(row.value)
        except json.JSONDecodeError as error:
            raise contract.ContractError(f"{row.path}: not a descriptor: {error}") from error
        if not isinstance(document, dict):
            raise contract.ContractError(f"{row.path}: not a descriptor: no object")
        documents.append((row.path, document))
    return documents


def audit_packages(
    spark: SparkSession,
    pattern: str,
    claims: DataFrame | None = None,
    require_self_description: bool = False,
    only: set[str] | None = None,
    local: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Violations of every package whose descriptor the pattern names.

    Packages are few and their tables large: the driver goes over the declarations, and
    each check is a job over a table. `claims` (dataset, stated) are row counts to hold to
    the tables; `local` redirects resources that a declared join reads to tables not published yet.
    What cannot be checked raises, and is never taken for a pass.
    """
    texts = descriptors.descriptor_texts(spark, pattern)
    documents = read_documents(texts)
    folder_of = {path: path.rsplit("/", 2)[-2] for path, _ in documents}
    missing = (only or set()) - set(folder_of.values())
    if missing or not documents:
        raise contract.ContractError(f"no descriptor for {sorted(missing) if missing else pattern}")
    chosen = [(path, d) for path, d in documents if not only or folder_of[path] in only]

    parsed = descriptors.parse_descriptors(texts, "value")
    fields = descriptors.contract_fields(parsed)
    tables: list[tuple[str, DataFrame]] = []  # two packages may have a resource of one name
    findings = [spark.createDataFrame([], contract.VIOLATION)]
    for path, document in chosen:
        package = document.get("name") or path
        for resource in document.get("resources") or []:
            name, place, schema = stated_resource(path, package, resource)
            table = spark.read.parquet(place)
            tables.append((name, table))
            mine = fields.where((F.col("package") == package) & (F.col("resource") == name))
            physical = contract.physical_fields(table, package, name)
            findings += [
                contract.check_field_set(mine, physical),
                contract.require_checkable(contract.check_types(mine, physical)),
                contract.check_constraints(table, contract.rules_of(fields, package, name), package, name),
                export.check_self_description(table, document, package, name, require_self_description),
            ]
            if "primaryKey" in schema:
                key = schema["primaryKey"]
                columns = [key] if isinstance(key, str) else key
                readable = isinstance(columns, list) and all(isinstance(c, str) for c in columns)
                findings.append(contract.check_primary_key(table, columns if readable else None, package, name))
            if resource.get("bytes") is not None:
                findings.append(check_bytes(spark, package, {**resource, "name": name}, place))
    findings.append(
        contract.check_foreign_keys(
            descriptors.contract_foreign_keys(parsed), fields, descriptors.contract_resources(parsed)
        )
    )
    if any("x-joins" in document for _, document in chosen):
        findings.append(joins.join_violations(run_declared(spark, documents, {d.get("name") for _, d in chosen}, local=local)))
    if claims is not None:
        checked = catalogue.check_catalogue(claims, catalogue.count_rows(tables))
        findings.append(catalogue.catalogue_violations(checked, "catalogue"))
    return contract.union_all(findings)


def stated_resource(path: str, package: str, resource: dict) -> tuple[str, str, dict]:
    """Name, place and schema of a resource; one that states no path or no fields cannot be checked."""
    name, schema = resource.get("name") or resource.get("path") or "<unnamed>", resource.get("schema") or {}
    for member, there in (("path", resource.get("path")), ("schema.fields", schema.get("fields"))):
        if not there:
            raise contract.ContractError(f"{package}: {name} has no {member}, so nothing of it can be checked")
    return name, locate(path, resource["path"]), schema


def run_declared(
    spark: SparkSession, documents: list[tuple[str, dict]], packages: set[str], write: bool = False,
    local: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """The declared joins of some packages, planned over all of them and measured. `write`: coverage need not be stated yet."""
    places = {
        (d.get("name") or path, r.get("name")): locate(path, r["path"])
        for path, d in documents for r in d.get("resources") or [] if r.get("path")
    }
    plan = joins.plan_joins(joins.documents_frame(spark, [d for _, d in documents]), write)
    return joins.run_joins(plan.where(F.col("package").isin(list(packages))), Published(spark, places), local)


def stamp_joins(spark: SparkSession, pattern: str, package: str, local: dict[str, DataFrame] | None = None) -> dict:
    """Write mode: the descriptor of a package with the coverage of all its declared joins as measured now."""
    documents = read_documents(descriptors.descriptor_texts(spark, pattern))
    [document] = [d for _, d in documents if d.get("name") == package] or [None]
    if document is None:
        raise contract.ContractError(f"no descriptor names {package}")
    return joins.with_coverage(document, run_declared(spark, documents, {package}, True, local))
