"""The same answers in DuckDB SQL over the same tables, written apart from the operators."""

from __future__ import annotations

from .queries import AS_OF, CLAIMS

LETTERS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ident(key: str) -> str:
    """An identifier with good check digits; Q counts as 26."""
    text = f"lpad(({key})::VARCHAR, 11, '0')"
    check = f"98 - (('52990026' || {text} || '00')::HUGEINT % 97)::INT"
    return f"('529900Q' || {text} || lpad(({check})::VARCHAR, 2, '0'))"


def mod97(text: str) -> str:
    clean = f"upper(trim({text}))"
    values = f"list_transform(string_split({clean}, ''), lambda c: strpos('{LETTERS}', c) - 1)"
    fold = f"list_reduce(list_prepend(0, {values}), lambda a, v: (a * (CASE WHEN v > 9 THEN 100 ELSE 10 END) + v) % 97)"
    return f"(CASE WHEN regexp_full_match({clean}, '[0-9A-Z]+') THEN {fold} END)"


def holds(text: str) -> str:
    return f"({mod97(text)} IS NOT DISTINCT FROM 1)"


CUSTOMERS = f"""
customers AS (
  SELECT *, CASE WHEN c_mktsegment = 'FURNITURE'
                 THEN left(good, 18) || lpad((right(good, 2)::INT + 1)::VARCHAR, 2, '0') ELSE good END AS lei
  FROM (SELECT *, {ident('c_custkey')} AS good FROM customer)
)"""

REGISTER = f"""{CUSTOMERS},
register AS (
  SELECT lei, c_name || ' Société' AS legal_name, n_name AS jurisdiction,
         CASE WHEN c_acctbal < 5000 THEN 'LAPSED' ELSE 'ISSUED' END AS reg_status
  FROM customers JOIN nation ON n_nationkey = c_nationkey WHERE c_acctbal >= 0
)"""

FILINGS = f"""{REGISTER},
filings AS (
  SELECT o_custkey::VARCHAR AS key,
         CASE WHEN o_orderstatus = 'P' THEN repeat('0', 20)
              WHEN o_orderpriority = '5-LOW' THEN replace(lei, '0', 'O')
              WHEN o_orderpriority = '1-URGENT' THEN '  ' || lower(lei) || ' '
              WHEN o_orderpriority = '3-MEDIUM' THEN ''
              ELSE lei END AS typed
  FROM orders JOIN customers ON c_custkey = o_custkey
),
admitted AS (
  SELECT key, lei FROM (SELECT DISTINCT key, upper(trim(typed)) AS lei FROM filings WHERE typed <> '') f
  WHERE {holds('lei')} OR EXISTS (SELECT 1 FROM register r WHERE r.lei = f.lei)
)"""

REGISTRATIONS = f"""
raw_registrations AS (
  SELECT lower(lei) AS lei, CASE WHEN c_acctbal < 0 THEN '' ELSE lpad(c_custkey::VARCHAR, 10, '0') END AS number,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'FUND' WHEN 'MACHINERY' THEN 'GENERAL' END AS category
  FROM customers WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE')
  UNION ALL SELECT {ident('s_suppkey')}, 'S' || lpad(s_suppkey::VARCHAR, 9, '0'), 'FUND' FROM supplier
  UNION ALL SELECT {ident('p_partkey')}, 'C' || lpad(p_partkey::VARCHAR, 9, '0') || ' ',
                   CASE WHEN p_type <> 'PROMO' THEN 'GENERAL' END FROM part
  UNION ALL SELECT {ident('o_custkey')}, '805-' || o_orderkey, 'GENERAL' FROM orders
),
registrations AS (
  SELECT upper(trim(lei)) AS lei,
         CASE WHEN number LIKE 'S%' THEN 'series' WHEN number LIKE 'C%' THEN 'class' ELSE 'cik' END AS key_type,
         CASE WHEN regexp_full_match(number, '[0-9]+') THEN number::BIGINT::VARCHAR ELSE trim(number) END AS key,
         category
  FROM raw_registrations
  WHERE number LIKE 'S%' OR number LIKE 'C%' OR regexp_full_match(number, '[0-9]+')
)"""

OFFICIAL = f"""{FILINGS},{REGISTRATIONS},
official AS (
  SELECT DISTINCT ON (key_type, key, lei) key_type, key, lei, category, method, 'authoritative' AS tier, 1.0::DOUBLE AS confidence
  FROM (
    SELECT key_type, key, lei, category, 'sec-registration' AS method, 0 AS rank FROM registrations
    UNION ALL SELECT 'cik', key, lei, 'FUND', 'sec-ncen', 1 FROM admitted
    UNION ALL SELECT 'series', 'S' || lpad(l_suppkey::VARCHAR, 9, '0'), {ident('l_suppkey')}, 'FUND', 'sec-ncen', 1
              FROM (SELECT DISTINCT l_suppkey FROM lineitem WHERE l_returnflag <> 'R')
  )
  ORDER BY key_type, key, lei, rank, category NULLS LAST
)"""


def named(match: str, guess: str) -> str:
    """Name matches of `guess`, less the keys that official edges cover."""
    return f"""
{match} AS (
  SELECT 'cik' AS key_type, key, lei, NULL::VARCHAR AS category, best.method AS method, best.tier AS tier,
         best.confidence AS confidence
  FROM (SELECT key, lei, max({{'confidence': confidence, 'method': method, 'tier': tier}}) AS best FROM {guess} GROUP BY ALL) g
  WHERE NOT EXISTS (SELECT 1 FROM official o WHERE o.key_type = 'cik' AND o.key = g.key)
),
edges AS (SELECT * FROM official UNION ALL BY NAME SELECT * FROM {match})"""


TIERED = f"""{OFFICIAL},
guessed AS (
  SELECT o_custkey::VARCHAR AS key, {ident('o_custkey')} AS lei,
         CASE WHEN o_orderstatus = 'F' THEN 'exact_name' ELSE 'jaro_winkler' END AS method,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'confirmed' WHEN '2-HIGH' THEN 'candidate' ELSE 'ambiguous' END AS tier,
         floor(o_totalprice) / 1e6 AS confidence
  FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
),{named('matched', 'guessed')}"""

UNIVERSE = """
universe AS (
  SELECT o_custkey::VARCHAR AS cik, min('Filer ' || o_custkey || ' ' || o_orderpriority) AS company_name,
         string_agg(DISTINCT CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderstatus || '-' || left(o_orderpriority, 1) END, ','
                    ORDER BY CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderstatus || '-' || left(o_orderpriority, 1) END) AS ticker
  FROM orders GROUP BY 1
)"""

ENRICHED = f"""
SELECT e.key_type, e.key, u.ticker, coalesce(u.company_name, r.legal_name) AS company_name, e.lei, r.legal_name,
       coalesce(e.category, 'GENERAL') AS category, r.jurisdiction, r.reg_status, e.method, e.tier,
       round(e.confidence, 6) AS confidence, DATE '{AS_OF}' AS as_of,
       lower(strip_accents(concat_ws(' ', coalesce(u.company_name, r.legal_name), r.legal_name, u.ticker, e.lei))) AS corpus
FROM edges e LEFT JOIN register r ON r.lei = e.lei LEFT JOIN universe u ON e.key_type = 'cik' AND u.cik = e.key"""


def normal(text: str) -> str:
    out = f"strip_accents(lower({text}))"
    for letter, spelled in {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "ł": "l", "đ": "d"}.items():
        out = f"replace({out}, '{letter}', '{spelled}')"
    out = f"trim(regexp_replace({out}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
    forms = ("ag|bv|co|company|corp|corporation|gmbh|inc|incorporated|limited|llc|llp|lp|ltd|nv|plc|sa|sarl|se|spa")
    return f"regexp_replace({out}, '(?: (?:{forms}))+$', '')"


NAMES = f"""
filers AS (
  SELECT * FROM (SELECT doc_id::VARCHAR AS id, {normal("split_part(text, chr(10), 1)")} AS name, lang AS country FROM documents)
  WHERE name <> ''
),
entities AS (
  SELECT * FROM (
    SELECT page_id::VARCHAR AS id, {normal("regexp_extract(html, '<title>([^<]*)</title>', 1)")} AS name,
           regexp_extract(html, '<html lang="([a-z]+)"', 1) AS country,
           CASE WHEN regexp_extract(url, '^https?://([^/?#]+)', 1) LIKE '%.com' THEN 0
                WHEN regexp_extract(url, '^https?://([^/?#]+)', 1) LIKE '%.net' THEN 1 ELSE 2 END AS rank,
           CASE WHEN url LIKE 'https:%' THEN 0 ELSE 1 END AS abroad
    FROM pages)
  WHERE name <> ''
)"""

STOPWORDS = "('a','an','and','das','de','der','die','el','en','in','la','le','les','los','of','the','to')"


def blocks(side: str) -> str:
    return f"""
  SELECT DISTINCT country, 'prefix' AS rule, left(name, 6) AS block, name FROM {side}
  UNION ALL SELECT DISTINCT country, 'word', split_part(name, ' ', 1), name FROM {side}
            WHERE split_part(name, ' ', 1) NOT IN {STOPWORDS}"""


SCORED = f"""{NAMES},
theirs AS (
  SELECT country, name, count(*) AS entities, min({{'rank': rank, 'abroad': abroad, 'id': id}}) AS winner FROM entities GROUP BY ALL
),
pairs AS (
  SELECT DISTINCT l.country, l.name, r.name AS other
  FROM ({blocks('filers')}) l JOIN ({blocks('entities')}) r USING (country, rule, block)
  WHERE NOT EXISTS (SELECT 1 FROM theirs t WHERE t.country = l.country AND t.name = l.name)
),
near AS (
  SELECT p.country, p.name, round(jaro_winkler_similarity(p.name, p.other), 9) AS similarity, t.winner
  FROM pairs p JOIN theirs t ON t.country = p.country AND t.name = p.other
),
scored AS (
  SELECT f.country, f.name, 'exact' AS level, 1.0::DOUBLE AS similarity, t.winner.id AS match, t.entities
  FROM (SELECT DISTINCT country, name FROM filers) f JOIN theirs t USING (country, name)
  UNION ALL
  SELECT country, name, CASE WHEN similarity >= 0.95 THEN 'close' ELSE 'near' END, round(similarity, 6), winner.id, 1
  FROM near
  WHERE similarity >= 0.92
  QUALIFY row_number() OVER (PARTITION BY country, name ORDER BY similarity DESC, winner) = 1
),
weighed AS (
  SELECT *, round(log2(1e-4 / (1 - 1e-4)) + log2(ratio), 6) AS weight,
         round(ratio * 1e-4 / (1 - 1e-4) / (1 + ratio * 1e-4 / (1 - 1e-4)), 6) AS match_probability
  FROM (SELECT *, CASE level WHEN 'exact' THEN 0.75 / 1e-6 WHEN 'close' THEN 0.15 / 5e-6 ELSE 0.07 / 2e-5 END AS ratio FROM scored)
),
resolved AS (
  SELECT f.id AS cik, w.match AS lei, CASE WHEN level = 'exact' THEN 'exact_name' ELSE 'jaro_winkler' END AS method,
         CASE WHEN level = 'exact' AND entities = 1 THEN 'confirmed' WHEN level = 'exact' THEN 'ambiguous' ELSE 'candidate' END AS status,
         match_probability
  FROM filers f JOIN weighed w USING (country, name)
)"""

LEVELS = {"name": {"exact": 0.6, "close": 0.2, "near": 0.1, "else": 0.1}, "tail": {"same": 0.9, "else": 0.1}, "words": {"same": 0.9, "else": 0.1}}


def learned(rounds: int = 25) -> str:
    """Patterns of all pairs that share a block, formed one by one, and the rounds of the estimation, a table each."""
    start = ", ".join(f"('{c}', '{level}', {share})" for c, x in LEVELS.items() for level, share in x.items())
    melted = " UNION ALL ".join(f"SELECT '{c}' AS c, \"{c}\" AS l, n, x, y FROM e{{0}}" for c in LEVELS)
    parts = [f"""{NAMES},
theirs AS (
  SELECT country, name, min({{'rank': rank, 'abroad': abroad, 'id': id}}) AS winner FROM entities GROUP BY ALL
),
pairs AS MATERIALIZED (
  SELECT *, CASE WHEN name = other THEN 'exact' WHEN similarity >= 0.95 THEN 'close' WHEN similarity >= 0.92 THEN 'near' ELSE 'else' END AS level,
         CASE WHEN split_part(name, ' ', -1) = split_part(other, ' ', -1) THEN 'same' ELSE 'else' END AS tail,
         CASE WHEN len(string_split(name, ' ')) = len(string_split(other, ' ')) THEN 'same' ELSE 'else' END AS words
  FROM (SELECT *, CASE WHEN name = other THEN 1.0::DOUBLE ELSE round(jaro_winkler_similarity(name, other), 9) END AS similarity
        FROM (SELECT DISTINCT l.country, l.name, r.name AS other
              FROM ({blocks('filers')}) l JOIN ({blocks('entities')}) r USING (country, rule, block)))
),
patterns AS MATERIALIZED (SELECT level AS name, tail, words, count(*)::DOUBLE AS n FROM pairs GROUP BY ALL),
shares AS (SELECT c, l, sum(n) / sum(sum(n)) OVER (PARTITION BY c) AS u
           FROM (SELECT 'name' AS c, name AS l, n FROM patterns UNION ALL SELECT 'tail', tail, n FROM patterns UNION ALL SELECT 'words', words, n FROM patterns)
           GROUP BY c, l),
q0 AS MATERIALIZED (SELECT s.c, s.l, s.m::DOUBLE AS m, u, 0.05::DOUBLE AS prior FROM (VALUES {start}) s(c, l, m) JOIN shares USING (c, l))"""]
    for i in range(1, rounds + 1):
        parts.append(f"""e{i} AS MATERIALIZED (
  SELECT p.*, a.prior * a.m * b.m * d.m AS x, (1 - a.prior) * a.u * b.u * d.u AS y FROM patterns p
  JOIN q{i - 1} a ON a.c = 'name' AND a.l = p.name JOIN q{i - 1} b ON b.c = 'tail' AND b.l = p.tail JOIN q{i - 1} d ON d.c = 'words' AND d.l = p.words),
q{i} AS MATERIALIZED (
  SELECT c, l, greatest(sum(n * x / (x + y)) / any_value(all_m), 1e-9) AS m, greatest(sum(n * y / (x + y)) / any_value(all_u), 1e-9) AS u, any_value(all_m / all_n) AS prior
  FROM ({melted.format(i)}), (SELECT sum(n * x / (x + y)) AS all_m, sum(n * y / (x + y)) AS all_u, sum(n) AS all_n FROM e{i}) t GROUP BY c, l)""")
    parts.append(f"model AS (SELECT c, l, m, u, prior, log2(m / u) AS weight FROM q{rounds})")
    return ",\n".join(parts)


MODEL = f"""WITH {learned()}
SELECT c AS comparison, l AS level, round(m, 6) AS m, round(u, 6) AS u, round(weight, 4) AS weight FROM model
UNION ALL SELECT 'prior', 'match', round(prior, 6), round(1 - prior, 6), round(log2(prior / (1 - prior)), 4) FROM (SELECT any_value(prior) AS prior FROM model)"""

ESTIMATED = f"""WITH {learned()},
judged AS (
  SELECT p.*, t.winner, round(1 / (1 + 1 / (a.prior / (1 - a.prior) * exp2(a.weight + b.weight + d.weight))), 6) AS p
  FROM pairs p JOIN theirs t ON t.country = p.country AND t.name = p.other
  JOIN model a ON a.c = 'name' AND a.l = p.level JOIN model b ON b.c = 'tail' AND b.l = p.tail JOIN model d ON d.c = 'words' AND d.l = p.words
  WHERE p.level <> 'else'
)
SELECT country, name, level, tail, words, round(similarity, 6) AS similarity, winner.id AS match, p AS match_probability
FROM judged QUALIFY row_number() OVER (PARTITION BY country, name ORDER BY p DESC, similarity DESC, winner) = 1""".replace("exp2(", "pow(2, ")

PLANNED_JOINS = """
WITH packages AS (
  SELECT *, replace(p_name, ' ', '_') || '_' AS stem FROM part
),
named AS (
  SELECT 'pkg' || p_partkey AS package, stem || p_size AS resource, stem || (51 - p_size) AS target, p_type AS kind, p_brand FROM packages
),
owned AS (SELECT resource AS target, count(*) AS owners, min(package) AS owner FROM named GROUP BY 1)
SELECT package, 'other' AS "join", CASE WHEN kind <> 'PROMO' THEN resource END AS resource, target, CASE WHEN owners = 1 THEN owner END AS owner,
       CASE kind WHEN 'LARGE' THEN 'fuzzy' WHEN 'STANDARD' THEN 'text' ELSE 'exact' END AS compare_as,
       CASE WHEN kind = 'ECONOMY' THEN 'maps 2 field(s) onto 1'
            WHEN kind = 'LARGE' THEN 'has no comparison fuzzy'
            WHEN p_brand = 'Brand#11' THEN 'its scope is not one field and one value'
            WHEN kind = 'MEDIUM' THEN 'its coverage has more matched rows than rows'
            WHEN kind = 'PROMO' THEN 'no resource of the package declares colour, brand'
            WHEN owners IS NULL THEN 'refers to ' || target || ', which no package declares'
            WHEN owners > 1 THEN 'refers to ' || target || ', of which there are ' || owners
            WHEN kind = 'SMALL' THEN 'refers to ' || target || '.weight, which is not declared' END AS finding
FROM named LEFT JOIN owned USING (target)"""

DECLARED_JOINS = """
WITH told(package, "join", resource, target, owner, compare_as, declared_rows, declared_matched) AS (VALUES
  ('sales', 'buyers', 'orders', 'customer', 'parties', 'exact', 15000, 15000),
  ('sales', 'pending', 'orders', 'labels', 'texts', 'text', 1, 0),
  ('sales', 'own lines', 'lineitem', 'orders', 'sales', 'exact', 60000, 12),
  ('sales', 'returned parts', 'lineitem', 'part', 'parties', 'exact', 20000, 20000),
  ('texts', 'judged', 'documents', 'judgements', 'quality', 'exact', 1000, 399),
  ('texts', 'english', 'documents', 'customer', 'parties', 'exact', 1000, 0)
),
met AS (
  SELECT 'buyers' AS "join", (SELECT count(*) FROM orders) AS rows, (SELECT count(*) FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer)) AS matched
  UNION ALL SELECT 'pending', count(*), count(*) FILTER (o_custkey IN (SELECT doc_id FROM labels WHERE quality = 1)) FROM orders WHERE o_orderstatus = 'P'
  UNION ALL SELECT 'own lines', count(*), count(o.k) FROM lineitem LEFT JOIN (SELECT DISTINCT o_orderkey AS k, o_custkey AS s FROM orders) o ON k = l_orderkey AND s = l_suppkey
  UNION ALL SELECT 'returned parts', count(*), count(*) FILTER (l_partkey IN (SELECT p_partkey FROM part)) FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL SELECT 'judged', count(*), count(*) FILTER (doc_id IN (SELECT doc_id FROM labels)) FROM documents WHERE lang = 'en'
  UNION ALL SELECT 'english', count(*), count(*) FILTER (TRY_CAST(lang AS BIGINT) IN (SELECT c_custkey FROM customer)) FROM documents
)
SELECT package, "join", resource, target, owner, compare_as, declared_rows::BIGINT AS declared_rows, declared_matched::BIGINT AS declared_matched,
       rows, matched, declared_rows = rows AND declared_matched = matched AS agrees, 'check' AS mode
FROM told JOIN met USING ("join")
UNION ALL SELECT package, "join", resource, target, owner, compare_as, rows, matched, rows, matched, true, 'written' FROM told JOIN met USING ("join")"""

PACKAGES = """
packages AS (
  SELECT *, 'pkg' || p_partkey AS package, replace(p_name, ' ', '_') || '_' || p_size AS resource,
         replace(p_name, ' ', '_') || '_' || (51 - p_size) AS target,
         CASE p_type WHEN 'STANDARD' THEN 'string' WHEN 'ECONOMY' THEN 'integer' WHEN 'LARGE' THEN 'number'
                     WHEN 'MEDIUM' THEN 'date' WHEN 'PROMO' THEN 'any' ELSE 'money' END AS key_type
  FROM part
),
fields AS (
  SELECT package, resource, 0 AS position, 'key' AS field, key_type AS type, '^[A-Z]+$' AS pattern, NULL::BIGINT AS min_length,
         NULL::BIGINT AS max_length, NULL AS enum, true AS required, '' AS unknown_constraints FROM packages
  UNION ALL SELECT package, resource, 1, 'brand', 'string', NULL, 1, p_size, NULL, false, '' FROM packages
  UNION ALL SELECT package, resource, 2, 'size', 'integer', NULL, NULL, NULL,
                   CASE WHEN p_type = 'PROMO' THEN '' ELSE '1|2|3' END, false,
                   CASE WHEN p_type = 'PROMO' THEN 'unique' ELSE '' END FROM packages
),
columns_there AS (
  SELECT package, resource, 'key' AS field, CASE WHEN p_size <= 25 THEN 'string' ELSE 'bigint' END AS physical FROM packages
  UNION ALL SELECT package, resource, 'brand', 'string' FROM packages WHERE p_type <> 'PROMO'
  UNION ALL SELECT package, resource, 'size', 'int' FROM packages
  UNION ALL SELECT package, resource, 'legacy', 'double' FROM packages WHERE p_type = 'SMALL'
)"""

FIELD_SET = f"""WITH {PACKAGES}
SELECT package, resource, 'brand' AS field, 'schema.fields' AS rule, 'declared, and the table has no such column' AS detail
FROM packages WHERE p_type = 'PROMO'
UNION ALL SELECT package, resource, 'legacy', 'schema.fields', 'the table has this column as double, undeclared'
FROM packages WHERE p_type = 'SMALL'"""

TYPES = f"""WITH {PACKAGES},
allowed(type, readable) AS (VALUES
  ('string', ['string']), ('integer', ['tinyint', 'smallint', 'int', 'bigint', 'hugeint']),
  ('number', ['tinyint', 'smallint', 'int', 'bigint', 'hugeint', 'float', 'double', 'decimal']), ('date', ['date']))
SELECT f.package, f.resource, f.field, CASE WHEN a.type IS NULL THEN 'type.unknown' ELSE 'type' END AS rule,
       CASE WHEN a.type IS NULL THEN 'declares unknown type ' || f.type
            ELSE 'declared ' || f.type || ' cannot be read from ' || c.physical || ' (only from '
                 || array_to_string(a.readable, ', ') || ')' END AS detail
FROM fields f JOIN columns_there c USING (package, resource, field) LEFT JOIN allowed a ON a.type = f.type
WHERE f.type <> 'any' AND (a.type IS NULL OR NOT list_contains(a.readable, c.physical))"""

FOREIGN_KEYS = f"""WITH {PACKAGES},
owners AS (SELECT resource AS target, count(*) AS owners FROM packages GROUP BY 1),
keyed AS (
  SELECT p.*, coalesce(o.owners, 0) AS owners,
         CASE p_type WHEN 'ECONOMY' THEN 'key,size' WHEN 'PROMO' THEN 'colour' ELSE 'key' END AS local
  FROM packages p LEFT JOIN owners o USING (target)
)
SELECT package, resource, local AS field, 'schema.foreignKeys' AS rule, detail FROM (
  SELECT *, CASE WHEN owners = 0 THEN 'refers to ' || target || ', which nothing declares'
                 WHEN owners > 1 THEN 'refers to ' || target || ', declared ' || owners || ' times'
                 WHEN p_type = 'ECONOMY' THEN 'maps 2 field(s) onto 1'
                 WHEN p_type = 'PROMO' THEN 'no such field here: colour'
                 WHEN p_type IN ('STANDARD', 'MEDIUM', 'SMALL')
                 THEN 'declared ' || key_type || ' refers to ' || target || '.size declared integer' END AS detail
  FROM keyed) WHERE detail IS NOT NULL"""


def probe(table: str, column: str, rule: str, said: str, breaks: str, text: str | None = None) -> str:
    """Counts for one constraint; `breaks` is over the value as text, `v`."""
    value = text or f"{column}::VARCHAR"
    return f"""
SELECT '{table}' AS resource, '{column}' AS field, 'constraints.{rule}' AS rule, '{said.replace("'", "''")}' AS description,
       count(*) FILTER (WHERE {breaks}) AS broken, count(v) AS checked, min(v) FILTER (WHERE {breaks}) AS example
FROM (SELECT {value} AS v FROM {table})"""


def probes(seen: str = "{}") -> dict[str, list[str]]:
    """Every constraint, by table; `seen` may hide values."""

    def p(table, column, rule, said, breaks):
        return probe(table, column, rule, said, breaks, seen.format(f"{column}::VARCHAR"))

    return {
        "part": [
            p("part", "p_brand", "pattern", "not matching Brand#[1-9]", "NOT regexp_full_match(v, 'Brand#[1-9]')"),
            p("part", "p_brand", "minLength", "shorter than 7", "length(v) < 7"),
            p("part", "p_brand", "maxLength", "longer than 7", "length(v) > 7"),
            p("part", "p_type", "enum", "outside an enum of 5", "v NOT IN ('ECONOMY','LARGE','MEDIUM','SMALL','STANDARD')"),
            p("part", "p_size", "required", "missing where required", "v IS NULL"),
            p("part", "p_size", "pattern", "not matching [0-9]{2}", "NOT regexp_full_match(v, '[0-9]{2}')"),
            p("part", "p_name", "pattern", "not matching [a-z]+ (ring|rod|bolt)", "NOT regexp_full_match(v, '[a-z]+ (ring|rod|bolt)')"),
            p("part", "p_retailprice", "maxLength", "longer than 5", "length(v) > 5"),
        ],
        "customer": [
            p("customer", "c_mktsegment", "required", "missing where required", "v IS NULL"),
            p("customer", "c_mktsegment", "enum", "outside an enum of 4", "v NOT IN ('AUTOMOBILE','FURNITURE','HOUSEHOLD','MACHINERY')"),
            p("customer", "c_name", "pattern", "not matching Customer#[0-9]{9}", "NOT regexp_full_match(v, 'Customer#[0-9]{9}')"),
            p("customer", "c_name", "maxLength", "longer than 18", "length(v) > 18"),
            p("customer", "c_nationkey", "enum", "outside an enum of 0", "v IS NOT NULL"),
            p("customer", "c_acctbal", "pattern", "not matching [0-9]+\\.[0-9]+", "NOT regexp_full_match(v, '[0-9]+\\.[0-9]+')"),
        ],
        "documents": [
            p("documents", "text", "required", "missing where required", "v IS NULL"),
            p("documents", "text", "pattern", "not matching (?s)[A-Z].*", "NOT regexp_full_match(v, '(?s)[A-Z].*')"),
            p("documents", "text", "minLength", "shorter than 100", "length(v) < 100"),
            p("documents", "text", "maxLength", "longer than 5000", "length(v) > 5000"),
            p("documents", "lang", "pattern", "not matching [a-z]{2}", "NOT regexp_full_match(v, '[a-z]{2}')"),
            p("documents", "lang", "enum", "outside an enum of 3", "v NOT IN ('de','en','fr')"),
            p("documents", "n_chars", "maxLength", "longer than 3", "length(v) > 3"),
        ],
        "labels": [
            p("labels", "quality", "enum", "outside an enum of 1", "v NOT IN ('1')"),
            p("labels", "toxic", "enum", "outside an enum of 2", "v NOT IN ('0','1')"),
        ],
        "events": [
            p("events", "event_type", "minLength", "shorter than 5", "length(v) < 5"),
            p("events", "event_type", "enum", "outside an enum of 4", "v NOT IN ('click','purchase','signup','view')"),
            p("events", "props", "pattern", '\\{"k": [0-9]\\}'.join(["not matching ", ""]), "NOT regexp_full_match(v, '\\{\"k\": [0-9]\\}')"),
            p("events", "props", "maxLength", "longer than 10", "length(v) > 10"),
            p("events", "value", "pattern", "not matching [0-9]+\\.[0-9]{2}", "NOT regexp_full_match(v, '[0-9]+\\.[0-9]{2}')"),
            p("events", "user_id", "maxLength", "longer than 2", "length(v) > 2"),
        ],
        "conversations": [
            p("conversations", "role", "enum", "outside an enum of 2", "v NOT IN ('assistant','user')"),
            p("conversations", "text", "minLength", "shorter than 40", "length(v) < 40"),
            p("conversations", "text", "maxLength", "longer than 2000", "length(v) > 2000"),
        ],
    }


def constraint_findings() -> str:
    found = probes()
    union = " UNION ALL ".join(x for t in ("part", "customer", "documents", "labels") for x in found[t])
    return f"""SELECT 'shop' AS package, resource, field, rule,
       format('{{:,}}', broken) || ' of ' || format('{{:,}}', checked) || ' value(s) ' || description
       || CASE WHEN example IS NULL THEN '' ELSE '; e.g. ''' || example || '''' END AS detail
FROM ({union}) WHERE broken > 0"""


def drift() -> str:
    hidden = probes("CASE WHEN NOT regexp_full_match({0}, '\\s*') THEN {0} END")
    union = " UNION ALL ".join(
        x for t in ("customer", "events", "conversations") for x in hidden[t] if "constraints.required" not in x
    )
    return f"SELECT * FROM ({union})"


KEYS = {
    "lineitem": ("lineitem", ["l_orderkey", "l_linenumber"]), "documents": ("documents", ["doc_id"]),
    "orders": ("orders", ["o_custkey"]), "events": ("events", ["user_id", "event_type"]),
    "conversations": ("conversations", ["conv_id", "turn"]),
    "labelled": ("(SELECT * FROM documents LEFT JOIN labels USING (doc_id))", ["lang", "quality"]),
}


def scan(name: str) -> str:
    source, columns = KEYS[name]
    shown = [f"CASE WHEN {c} IS NULL THEN 'NULL' ELSE '''' || {c} || '''' END" for c in columns]
    key = shown[0] if len(shown) == 1 else "'(' || " + " || ', ' || ".join(shown) + " || ')'"
    missing = " OR ".join(f"{c} IS NULL" for c in columns)
    return f"""
SELECT '{name}' AS resource, '{",".join(columns)}' AS columns, coalesce(sum(n), 0)::BIGINT AS rows,
       coalesce(sum(n) FILTER (WHERE missing), 0)::BIGINT AS null_rows, min(key) FILTER (WHERE missing) AS null_example,
       count(*) FILTER (WHERE NOT missing AND n > 1) AS duplicate_values,
       coalesce(sum(n) FILTER (WHERE NOT missing AND n > 1), 0)::BIGINT AS duplicate_rows,
       min(key) FILTER (WHERE NOT missing AND n > 1) AS duplicate_example,
       max(n) FILTER (WHERE NOT missing AND n > 1) AS widest_duplicate
FROM (SELECT count(*) AS n, ({missing}) AS missing, {key} AS key FROM {source} GROUP BY {", ".join(columns)})"""


KEY_SCAN = " UNION ALL ".join(scan(name) for name in KEYS)

PRIMARY_KEYS = f"""
SELECT 'shop' AS package, resource, replace(columns, ',', ', ') AS field, 'schema.primaryKey.duplicate' AS rule,
       format('{{:,}}', duplicate_rows) || ' of ' || format('{{:,}}', rows) || ' row(s) share a key, over '
       || format('{{:,}}', duplicate_values) || ' repeated value(s), the widest on ' || format('{{:,}}', widest_duplicate)
       || ' row(s); e.g. ' || duplicate_example AS detail
FROM ({KEY_SCAN}) WHERE resource <> 'labelled' AND duplicate_rows > 0
UNION ALL
SELECT 'shop', resource, replace(columns, ',', ', '), 'schema.primaryKey.null',
       format('{{:,}}', null_rows) || ' of ' || format('{{:,}}', rows) || ' row(s) have no complete key; e.g. ' || null_example
FROM ({KEY_SCAN}) WHERE resource <> 'labelled' AND null_rows > 0"""


def profile(table: str, columns: dict[str, str]) -> str:
    parts = []
    for at, (column, kind) in enumerate(columns.items()):
        parts.append(f"""
SELECT '{table}' AS resource, {at} AS position, '{column}' AS column, '{kind}' AS type, count(*) AS rows,
       count(*) - count(v) AS nulls, count(DISTINCT v) AS distinct_values, min(length(v))::INT AS min_length,
       max(length(v))::INT AS max_length,
       CASE WHEN count(DISTINCT v) BETWEEN 1 AND 50 THEN string_agg(DISTINCT v, '|' ORDER BY v) END AS domain
FROM (SELECT {column}{"::DATE || ' 00:00:00'" if kind == "datetime" else "::VARCHAR"} AS v FROM {table})""")
    return " UNION ALL ".join(parts)


CUSTOMER_PROFILE = profile("customer", {
    "c_custkey": "integer", "c_name": "string", "c_nationkey": "integer", "c_acctbal": "number", "c_mktsegment": "string"})
PROFILES = " UNION ALL ".join([
    CUSTOMER_PROFILE,
    profile("part", {"p_partkey": "integer", "p_name": "string", "p_brand": "string", "p_type": "string",
                     "p_size": "integer", "p_retailprice": "number"}),
    profile("lineitem", {"l_orderkey": "integer", "l_partkey": "integer", "l_suppkey": "integer", "l_linenumber": "integer",
                         "l_quantity": "number", "l_extendedprice": "number", "l_discount": "number", "l_tax": "number",
                         "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "datetime"}),
])

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations"]
COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS dataset, count(*) AS rows FROM {t}" for t in TABLES)
CATALOGUE = f"""
WITH claims(dataset, stated) AS (VALUES {", ".join(f"('{d}', '{s}')" for d, s in CLAIMS)}),
counts AS ({COUNTS}),
both_sides AS (
  SELECT dataset, stated, rows, regexp_full_match(stated, '[0-9]{{1,3}}(,[0-9]{{3}})+|[0-9]+') AS whole,
         regexp_full_match(stated, '[0-9]+([.][0-9]+)?[KMB]') AS short,
         length(regexp_extract(stated, '[.]([0-9]+)', 1)) AS places,
         CASE right(stated, 1) WHEN 'K' THEN 1000 WHEN 'M' THEN 1000000 ELSE 1000000000 END::HUGEINT AS scale
  FROM claims FULL JOIN counts USING (dataset)
),
units AS (SELECT *, (rows * (10 ** places)::HUGEINT * 2 + scale) // (2 * scale) AS units, (10 ** places)::HUGEINT AS shift FROM both_sides),
measured AS (
  SELECT *, CASE WHEN whole AND stated LIKE '%,%' THEN format('{{:,}}', rows) WHEN whole THEN rows::VARCHAR
                 WHEN short THEN (units // shift)::VARCHAR
                      || CASE WHEN places > 0 THEN '.' || lpad((units % shift)::VARCHAR, places::INT, '0') ELSE '' END
                      || right(stated, 1) END AS figure
  FROM units
)
SELECT dataset, stated, rows, coalesce(figure, stated) AS rewritten,
       CASE WHEN stated IS NULL THEN 'catalogue.missing' WHEN rows IS NULL THEN 'catalogue.unknown'
            WHEN figure IS NULL THEN 'catalogue.unreadable' WHEN figure <> stated THEN 'catalogue.rows' END AS finding
FROM measured"""

REFUSAL = """CASE WHEN o_orderpriority = '2-HIGH' THEN 'never reached the step that writes the descriptor'
       WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'wrote another descriptor'
       WHEN o_orderstatus = 'P' THEN 'did not finish' END"""

DIFFS = {
    "/tags": ("o_orderpriority = '1-URGENT'", "length", "'2'", "'3'"),
    "/tags/1": ("o_orderpriority <> '1-URGENT' AND o_orderstatus = 'P'", "value", "'\"P\"'", "'\"Q\"'"),
    "/price": ("o_orderpriority = '2-HIGH'", "kind", "'object'", "'number'"),
    "/status": ("o_orderpriority = '3-MEDIUM'", "absent", "'string'", "NULL"),
    "/note": ("o_orderpriority = '4-NOT SPECIFIED'", "unexpected", "NULL", "'object'"),
}
REASONED = """
reasons AS (
  SELECT o_custkey, 'run' || o_orderkey AS run_id, strftime(o_orderdate, '%Y-%m-%d') AS began, 'runs/' || lpad(o_orderkey::VARCHAR, 12, '0') AS source,
         CASE WHEN o_orderpriority = '2-HIGH' THEN 'step' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'digest'
              WHEN o_orderstatus = 'P' THEN 'outcome' END AS rung,
         CASE WHEN o_orderpriority = '2-HIGH' THEN 'describe was skipped and no reason is given'
              WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'wrote ' || left(sha256('descriptor ' || o_custkey || ' old'), 12) || ', the object has ' || left(sha256('descriptor ' || o_custkey), 12)
              WHEN o_orderstatus = 'P' THEN 'ended as partial; failed: verify' END AS reason
  FROM orders WHERE NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'F')
),
told AS (
  SELECT c_custkey::VARCHAR AS object, run_id, began, source, rung, CASE WHEN run_id IS NULL THEN 'no run produced these bytes' ELSE reason END AS reason
  FROM customer LEFT JOIN reasons ON o_custkey = c_custkey
)"""

STATES = """
states AS (
  SELECT version, 'u' || c_custkey AS uid, CASE
           WHEN version > 1 AND c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'new' || c_custkey
           WHEN version = 3 AND c_mktsegment = 'HOUSEHOLD' THEN 'set' || (c_custkey + 1) ELSE 'set' || c_custkey END AS name,
         CASE WHEN version > 1 AND c_mktsegment = 'MACHINERY' THEN 'set' || c_custkey END AS alias
  FROM customer, (VALUES (1), (2), (3)) v(version) WHERE NOT (version = 2 AND c_mktsegment = 'FURNITURE')
),
answers AS (
  SELECT version, uid, 'source.' || name AS address, false AS retired FROM states
  UNION SELECT version, uid, 'source.' || alias, true FROM states WHERE alias IS NOT NULL
)"""


def described(table: str, columns: dict[str, str], enums: dict[str, list[str]] | None = None) -> str:
    """Formats and domains: each pattern is tried on every value, a listing is made where there are 50 values or fewer."""
    patterns = [
        ("integer", "[+-]?[0-9]+"), ("number", "[+-]?[0-9]*[.]?[0-9]+([eE][+-]?[0-9]+)?"), ("date", "[0-9]{4}-[0-9]{2}-[0-9]{2}"),
        ("datetime", "[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?(Z|[+-][0-9]{2}:?[0-9]{2})?"),
        ("uri", "[A-Za-z][A-Za-z0-9+.-]*://[^ \t\n\x0b\f\r]+"), ("code", "[A-Z0-9]+([-_#][A-Z0-9]+)*"),
        ("word", "[^ \t\n\x0b\f\r]+"), ("line", "[^\n\r]*"),
    ]
    kind = " ".join(f"WHEN bool_and(regexp_full_match(v, '{p}')) THEN '{name}'" for name, p in patterns)
    parts = []
    for at, (column, text) in enumerate(columns.items()):
        enum = (enums or {}).get(column)
        listed = "[" + ", ".join(f"'{v}'" for v in enum) + "]" if enum else "NULL::VARCHAR[]"
        parts.append(f"""
SELECT '{table}' AS resource, {at} AS position, '{column}' AS "column", CASE WHEN count(v) = 0 THEN NULL {kind} ELSE 'text' END AS format,
       count(v) AS rows, count(DISTINCT v) AS distinct_values,
       CASE WHEN count(DISTINCT v) <= 50 THEN coalesce(list(DISTINCT v ORDER BY v) FILTER (v IS NOT NULL), []) END AS d, {listed} AS e
FROM (SELECT {text} AS v FROM {table})""")
    minus = lambda a, b: f"list_sort(list_filter({a}, lambda x: NOT list_contains({b}, x)))"
    shown = lambda x: f"CASE WHEN d IS NOT NULL AND e IS NOT NULL THEN to_json({x})::VARCHAR END"
    return f"""
SELECT resource, position, "column", format, rows, distinct_values, CASE WHEN d IS NOT NULL THEN to_json(d)::VARCHAR END AS domain,
       d IS NULL OR (e IS NOT NULL AND len({minus('e', 'd')}) > 0) AS open, {shown(minus('d', 'e'))} AS outside, {shown(minus('e', 'd'))} AS unseen
FROM ({" UNION ALL ".join(parts)})"""


def own_text(*columns: str) -> dict[str, str]:
    return {c: f"{c}::VARCHAR" for c in columns}


def changed(table: str, after: str) -> str:
    return f"""
SELECT '{table}' AS resource, (SELECT count(*) FROM {table}) AS rows, (SELECT count(*) FROM ({after})) AS rows_after,
       NOT EXISTS (SELECT * FROM {table} EXCEPT ALL ({after})) AND NOT EXISTS (({after}) EXCEPT ALL SELECT * FROM {table}) AS unchanged"""


SPACES = "trim(regexp_replace(text, '\\s+', ' ', 'g'))"

ORACLES = {
    "load_register": f"""WITH {CUSTOMERS}
SELECT lei, c_name || ' Société ' || n_name AS legal_name, n_name AS country,
       CASE WHEN c_acctbal >= 0 THEN upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) END AS city,
       r_name AS jurisdiction, 'F' || lpad(c_nationkey::VARCHAR, 3, '0') AS legal_form,
       CASE WHEN c_acctbal < 0 THEN 'NULL' WHEN c_acctbal < 5000 THEN 'INACTIVE' ELSE 'ACTIVE' END AS entity_status,
       CASE WHEN c_acctbal < 2000 THEN 'LAPSED' WHEN c_acctbal < 4000 THEN 'RETIRED' ELSE 'ISSUED' END AS registration_status,
       TRY_CAST(started[1:10] AS DATE) AS initial_registration,
       TRY_CAST(CASE WHEN c_mktsegment <> 'MACHINERY' THEN started ELSE '' END[1:10] AS DATE) AS next_renewal,
       lower(strip_accents(concat_ws(' ', c_name, 'Société', n_name,
         CASE WHEN c_acctbal >= 0 THEN c_mktsegment END, n_name))) AS corpus
FROM (SELECT *, '20' || lpad(c_nationkey::VARCHAR, 2, '0') || '-' || lpad((floor(abs(c_acctbal) / 700)::BIGINT + 1)::VARCHAR, 2, '0')
             || '-15T08:30:00.000Z' AS started FROM customers)
JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "slice_dates": """SELECT o_orderkey, written, TRY_CAST(written[1:10] AS DATE) AS day FROM (
  SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN '19x' || stamp WHEN '2-HIGH' THEN left(stamp, 4)
         WHEN '3-MEDIUM' THEN replace(stamp, '-0', '-3') WHEN '4-NOT SPECIFIED' THEN '' ELSE stamp || '.000Z' END AS written
  FROM (SELECT *, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS stamp FROM orders))""",
    "flatten_positional": """SELECT cik, company_name, ticker, exchange,
       lower(strip_accents(concat_ws(' ', company_name, ticker, exchange))) AS corpus
FROM (SELECT c_custkey::VARCHAR AS cik, c_name AS company_name, left(c_mktsegment, 4) AS ticker,
             CASE WHEN c_acctbal >= 0 THEN 'X' || c_nationkey END AS exchange FROM customer)""",
    "union_by_name_scan": """SELECT o_orderkey::VARCHAR AS o_orderkey,
       CASE WHEN o_orderstatus <> 'P' THEN o_custkey::VARCHAR END AS o_custkey, o_orderpriority FROM orders""",
    "parse_trailing_key": """SELECT p_partkey::VARCHAR AS cik,
       CASE WHEN p_type = 'PROMO' THEN p_name || ': ' || p_brand ELSE p_name END AS company_name
FROM part WHERE p_type <> 'LARGE' AND (p_type <> 'SMALL' OR length(p_partkey::VARCHAR) = 10)""",
    "derive_level": f"""SELECT code, title, CASE WHEN code LIKE '%-%' OR length(code) = 2 THEN 'sector'
       WHEN length(code) = 3 THEN 'subsector' WHEN length(code) = 4 THEN 'industry_group'
       WHEN length(code) = 5 THEN 'naics_industry' WHEN length(code) = 6 THEN 'national_industry' END AS level,
       description, lower(strip_accents(concat_ws(' ', title, description))) AS corpus
FROM (SELECT CASE WHEN lang = 'de' THEN left(n_chars::VARCHAR, 2) || '-99' ELSE n_chars::VARCHAR END AS code,
             CASE WHEN lang = 'fr' THEN source ELSE source || 'T1' END AS title,
             CASE WHEN lang <> 'es' AND lower(trim(text)) NOT IN ('', 'null') THEN {SPACES} END AS description FROM documents)""",
    "type_registrations": f"WITH {CUSTOMERS},{REGISTRATIONS} SELECT * FROM registrations",
    "normalise_id": "SELECT c_custkey, c_custkey::VARCHAR AS unpadded, upper(c_name) AS tidy FROM customer",
    "lei_mod97": f"""WITH {CUSTOMERS}
SELECT c_custkey, typed, {mod97('typed')}::INT AS remainder, {holds('typed')} AS holds
FROM (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN replace(lei, '0', 'O')
             WHEN c_mktsegment = 'MACHINERY' THEN ' ' || lower(lei)
             WHEN c_acctbal < 0 THEN left(lei, 5) || '-' || substr(lei, 7) ELSE lei END AS typed FROM customers)""",
    "search_corpus": "SELECT doc_id, lower(strip_accents(concat_ws(' ', text, lang, source))) AS corpus FROM documents",
    "entity_universe": """SELECT c_custkey::VARCHAR AS cik, c_name || ': ' || c_mktsegment AS company_name, ticker, exchange
FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderpriority) AS ticker, min(o_orderstatus) AS exchange
                         FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON o_custkey = c_custkey""",
    "distinct_listagg": """SELECT p_type AS cik, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS ticker,
       min(p_name) AS company_name FROM part GROUP BY 1""",
    "dedup_best": """SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_totalprice, o_orderstatus
FROM orders ORDER BY o_custkey, o_totalprice DESC, o_orderkey""",
    "dedup_edges": """SELECT DISTINCT ON (l_partkey, l_suppkey) 'cik' AS key_type, l_partkey::VARCHAR AS key,
       l_suppkey::VARCHAR AS lei, CASE WHEN l_returnflag <> 'A' THEN l_linestatus END AS category,
       CASE WHEN l_returnflag = 'R' THEN 'sec-registration' ELSE 'sec-ncen' END AS method,
       'authoritative' AS tier, 1.0::DOUBLE AS confidence
FROM lineitem ORDER BY l_partkey, l_suppkey, CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END,
  CASE WHEN l_returnflag <> 'A' THEN l_linestatus END NULLS LAST""",
    "admit_identifiers": f"WITH {FILINGS} SELECT key, lei FROM admitted",
    "tier_edges": f"WITH {TIERED} SELECT * FROM edges",
    "enrich_edges": f"WITH {TIERED},{UNIVERSE} {ENRICHED}",
    "identifier_gate": f"""WITH {FILINGS}
SELECT count(*) AS edges, count(DISTINCT lei) AS distinct_ids,
       array_to_string(list_slice(list_sort(list(DISTINCT lei)), 1, 5), ', ') AS examples
FROM (SELECT upper(trim(typed)) AS lei FROM filings WHERE typed <> '') f
WHERE NOT {holds('lei')} AND NOT EXISTS (SELECT 1 FROM register r WHERE r.lei = f.lei)""",
    "excluded_keys": f"""WITH {FILINGS},
keys AS (SELECT 'cik' AS key_type, key FROM filings
         UNION SELECT 'series', 'S' || lpad(l_suppkey::VARCHAR, 9, '0') FROM lineitem)
SELECT key_type, key FROM keys k
WHERE NOT EXISTS (SELECT 1 FROM admitted a WHERE k.key_type = 'cik' AND a.key = k.key)
  AND NOT EXISTS (SELECT 1 FROM supplier WHERE k.key_type = 'series' AND 'S' || lpad(s_suppkey::VARCHAR, 9, '0') = k.key)""",
    "block_pairs": f"""WITH {NAMES}
SELECT country, rule, block, l.n AS left_names, r.n AS register_names, l.n * r.n AS pairs
FROM (SELECT country, rule, block, count(*) AS n FROM ({blocks('filers')}) GROUP BY ALL) l
JOIN (SELECT country, rule, block, count(*) AS n FROM ({blocks('entities')}) GROUP BY ALL) r USING (country, rule, block)""",
    "link_scores": f"WITH {SCORED} SELECT country, name, level, similarity, match, entities, weight, match_probability FROM weighed",
    "resolve_entities": f"WITH {SCORED} SELECT * FROM resolved",
    "crosswalk": f"""WITH {OFFICIAL},{UNIVERSE},{SCORED},
guessed AS (SELECT cik AS key, upper(lei) AS lei, method, status AS tier, match_probability AS confidence FROM resolved),
{named('matched', 'guessed')} {ENRICHED}""",
    "estimate_model": MODEL,
    "estimated_links": ESTIMATED,
    "published_crosswalk": f"""WITH {TIERED},{UNIVERSE},
whole AS ({ENRICHED}),
names_nothing AS (
  SELECT lei FROM (SELECT DISTINCT lei FROM whole) w
  WHERE NOT {holds('lei')} AND NOT EXISTS (SELECT 1 FROM register r WHERE r.lei = w.lei))
SELECT company_name, key_type, key, lei, method, tier,
       row_number() OVER (ORDER BY company_name NULLS FIRST, key_type, key, lei) AS rank
FROM whole w WHERE NOT EXISTS (SELECT 1 FROM names_nothing b WHERE b.lei = w.lei)""",
    "plan_joins": PLANNED_JOINS,
    "declared_joins": DECLARED_JOINS,
    "contract_fields": f"WITH {PACKAGES} SELECT * FROM fields",
    "contract_keys": f"""WITH {PACKAGES}
SELECT package, resource, CASE p_type WHEN 'LARGE' THEN '["key","brand"]' WHEN 'SMALL' THEN '[]' WHEN 'MEDIUM' THEN '7' ELSE 'key' END AS declared,
       CASE WHEN p_type = 'LARGE' THEN 'key|brand' WHEN p_type NOT IN ('SMALL', 'MEDIUM') THEN 'key' END AS columns FROM packages""",
    "resource_index": f"""WITH {PACKAGES}
SELECT resource, count(*) AS declarations, min(package) AS package, max(package) AS last_package, count(*) > 1 AS ambiguous
FROM packages GROUP BY 1""",
    "check_field_set": FIELD_SET,
    "check_types": TYPES,
    "check_foreign_keys": FOREIGN_KEYS,
    "check_constraints": constraint_findings(),
    "key_scan": KEY_SCAN,
    "check_primary_key": PRIMARY_KEYS,
    "drift_contract": drift(),
    "join_coverage": """SELECT "join", declared_rows, declared_matched, rows, matched,
       rows = declared_rows AND matched = declared_matched AS agrees
FROM (
  SELECT 'labels' AS "join", 1000::BIGINT AS declared_rows, 399::BIGINT AS declared_matched, count(*) AS rows, count(l.doc_id) AS matched
  FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = d.doc_id
  UNION ALL SELECT 'english', 620, 1, count(*), count(l.doc_id)
  FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = d.doc_id WHERE lang = 'en'
  UNION ALL SELECT 'parts', 60000, 60000, count(*), count(p_partkey) FROM lineitem LEFT JOIN part ON p_partkey = l_partkey
  UNION ALL SELECT 'orders', 60000, 0, count(*), count(o_orderkey)
  FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND o_custkey = l_suppkey)""",
    "join_coverage_text": """WITH keys AS (
  SELECT 'cik' AS key_type, o_custkey::VARCHAR AS key FROM orders
  UNION ALL SELECT 'series', 'S' || l_suppkey FROM lineitem),
met AS (SELECT key_type, c_custkey FROM keys LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) ON c_custkey::VARCHAR = key)
SELECT 'filers' AS "join", count(*) AS rows, count(c_custkey) AS matched FROM met WHERE key_type = 'cik'
UNION ALL SELECT 'everything', count(*), count(c_custkey) FROM met""",
    "join_sample": """SELECT o_custkey::VARCHAR AS key FROM orders JOIN customer ON c_custkey = o_custkey AND c_acctbal >= 0
ORDER BY key LIMIT 20""",
    "profile_columns": PROFILES,
    "overlay_descriptor": f"""SELECT position, p.column, coalesce(o.type, p.type) AS type, o.description, o.pattern,
       coalesce(o.low, p.min_length) AS min_length, coalesce(o.high, p.max_length) AS max_length,
       coalesce(o.required, false) AS required, o.column IS NOT NULL AS curated
FROM ({CUSTOMER_PROFILE}) p LEFT JOIN (VALUES
  ('c_custkey', 'string', 'the customer''s number', '[0-9]+', 1, 12, true),
  ('c_mktsegment', NULL, 'trade', NULL, NULL, 20, NULL)) o("column", type, description, pattern, low, high, required) USING ("column")""",
    "catalogue_counts": CATALOGUE,
    "verify_objects": """SELECT d.doc_id::VARCHAR AS object, n_chars AS declared_bytes, m.bytes,
       CASE WHEN m.bytes IS NULL THEN 'object.missing' WHEN n_chars <> m.bytes THEN 'resource.bytes'
            WHEN stated <> m.hash THEN 'resource.hash' END AS finding,
       coalesce(m.bytes, n_chars) AS stamped_bytes, coalesce(m.hash, stated) AS stamped_hash
FROM (SELECT *, 'sha256:' || sha256(CASE WHEN lang = 'de' THEN trim(text) ELSE replace(text, 'e', 'E') END) AS stated FROM documents) d
LEFT JOIN (SELECT doc_id, strlen(text)::BIGINT AS bytes, 'sha256:' || sha256(text) AS hash FROM documents WHERE source <> 'src7') m USING (doc_id)""",
    "content_digest": """SELECT 'lineitem' AS resource, count(*) AS rows, count(*) AS rows_after, true AS unchanged FROM lineitem
UNION ALL SELECT 'documents', count(*), count(*), true FROM documents""",
    "total_order_export": "SELECT count(*) AS rows, 0::BIGINT AS out_of_order, 0::BIGINT AS overlapping_files FROM orders",
    "total_order_rank": """SELECT o_orderkey, row_number() OVER (ORDER BY o_orderpriority NULLS FIRST, o_orderdate NULLS FIRST, o_orderkey NULLS FIRST) AS rank
FROM orders""",
    "parquet_layout": "SELECT count(*) AS rows, 1000::BIGINT AS widest_row_group, 'zstd' AS codec FROM lineitem",
    "self_description": """SELECT 'shop' AS package, 'customer' AS resource, field, rule, detail FROM (VALUES
  ('', 'self-description', 'differs at /title: absent'),
  ('c_phone', 'self-description.schema.fields', 'declared, and the table has no such column'),
  ('c_mktsegment', 'self-description.schema.fields', 'the table has this column as string, undeclared'),
  ('c_custkey', 'self-description.type', 'declared string cannot be read from bigint (only from string)')) v(field, rule, detail)
UNION ALL SELECT 'shop', 'customer', 'c_nationkey', 'self-description.schema.primaryKey.duplicate',
  format('{:,}', sum(n) FILTER (WHERE n > 1)) || ' of ' || format('{:,}', sum(n)) || ' row(s) share a key, over '
  || format('{:,}', count(*) FILTER (WHERE n > 1)) || ' repeated value(s), the widest on ' || format('{:,}', max(n))
  || ' row(s); e.g. ''' || min(c_nationkey::VARCHAR) FILTER (WHERE n > 1) || ''''
FROM (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1)""",
    "run_provenance": f"""WITH claims AS (
  SELECT o_custkey, 'run' || o_orderkey AS run_id, strftime(o_orderdate, '%Y-%m-%d') AS started, o_orderkey, {REFUSAL} AS refusal
  FROM orders WHERE NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'F'))
SELECT c_custkey::VARCHAR AS object, count(run_id) AS claimants, count(run_id) FILTER (WHERE refusal IS NULL) AS licensing,
       arg_max(run_id, (started, o_orderkey)) FILTER (WHERE refusal IS NULL AND run_id IS NOT NULL) AS run_id,
       CASE WHEN count(run_id) = 0 THEN 'no run produced these bytes'
            WHEN count(run_id) FILTER (WHERE refusal IS NULL) = 0 THEN arg_max(refusal, (started, o_orderkey)) END AS refusal
FROM customer LEFT JOIN claims ON o_custkey = c_custkey GROUP BY 1""",
    "run_reasons": f"WITH {REASONED} SELECT object, run_id, rung, reason FROM told",
    "run_refusals": f"""WITH {REASONED},
said AS (SELECT object, reason, count(run_id) AS runs, max({{'began': began, 'source': source, 'run_id': run_id}}) AS newest,
                count(*) FILTER (run_id IS NOT NULL AND reason IS NULL) > 0 AS licensed FROM told GROUP BY object, reason)
SELECT object, bool_or(licensed) AS licensed, sum(runs)::BIGINT AS claimants,
       CASE WHEN NOT bool_or(licensed) THEN string_agg(CASE WHEN newest.run_id IS NULL THEN reason ELSE newest.run_id || ' (' || runs || ') ' || reason END, '; '
            ORDER BY newest.began DESC, newest.source DESC) END AS refusal
FROM said GROUP BY object""",
    "address_history": f"""WITH {STATES},
versions AS (SELECT uid, address, list_sort(list(DISTINCT version)) AS vs, max(version) FILTER (NOT retired) AS own FROM answers GROUP BY ALL)
SELECT uid, address, f AS first_version, l AS last_version, (SELECT max(version) FROM answers a WHERE a.uid = v.uid AND a.address = v.address AND NOT retired AND version BETWEEN f AND l) AS last_own
FROM (SELECT uid, address, vs[1] AS f, CASE WHEN vs = [1, 3] THEN 1 ELSE vs[-1] END AS l FROM versions UNION ALL SELECT uid, address, 3, 3 FROM versions WHERE vs = [1, 3]) v""",
    "history_violations": f"""WITH {STATES},
owns AS (SELECT version, uid, 'source.' || name AS address, 'source.' || alias AS old FROM states),
leads AS (SELECT version, address, min(uid) AS uid FROM answers GROUP BY ALL)
SELECT 'uid.reused' AS rule, a.uid AS subject, b.version, a.address AS before, b.address AS after FROM owns a JOIN owns b USING (uid)
WHERE a.version = (SELECT max(version) FROM owns c WHERE c.uid = b.uid AND c.version < b.version) AND a.address <> b.address AND b.old IS DISTINCT FROM a.address
UNION ALL SELECT 'uid.gone', uid, 2, 'source.set' || substr(uid, 2), NULL FROM (SELECT uid FROM owns WHERE version = 1 EXCEPT SELECT uid FROM owns WHERE version = 2)
UNION ALL SELECT 'uid.returned', uid, 3, '1', address FROM owns o WHERE version = 3 AND NOT EXISTS (SELECT 1 FROM owns c WHERE c.uid = o.uid AND c.version = 2)
UNION ALL SELECT 'address.repointed', b.address, b.version, a.uid, b.uid FROM leads a JOIN leads b USING (address)
WHERE a.version = (SELECT max(version) FROM leads c WHERE c.address = b.address AND c.version < b.version) AND a.uid <> b.uid""",
    "describe_columns": " UNION ALL ".join([
        described("orders", own_text("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice") | {"o_orderdate": "o_orderdate::DATE || ' 00:00:00'"} | own_text("o_orderpriority"),
                  {"o_orderstatus": ["F", "O", "P", "X"], "o_orderpriority": ["1-URGENT", "2-HIGH"]}),
        described("documents", own_text("doc_id", "text", "lang", "source", "n_chars")),
        described("events", own_text("event_id") | {"ts": "strftime(ts, '%Y-%m-%d %H:%M:%S') || CASE WHEN microsecond(ts) % 1000000 > 0 THEN rtrim('.' || lpad((microsecond(ts) % 1000000)::VARCHAR, 6, '0'), '0') ELSE '' END"} | own_text("user_id", "event_type", "value", "props"), {"event_type": ["click"]}),
    ]),
    "content_changed": " UNION ALL ".join([
        changed("nation", "SELECT * FROM nation UNION ALL SELECT * FROM nation WHERE n_nationkey = 3"),
        changed("supplier", "SELECT * FROM supplier WHERE s_suppkey <> 7"),
        changed("customer", "SELECT * REPLACE (CASE WHEN c_custkey = 5 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal) FROM customer"),
        changed("part", "SELECT * FROM part"),
    ]),
    "run_errors": """SELECT 'runs/' || lpad(o_orderkey::VARCHAR, 12, '0') AS source, 'declares contract version b4/0' AS error
FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'F'""",
    "registry_invariants": """WITH entries AS (
  SELECT 'u' || s_suppkey AS uid, 'source.' || lower(replace(s_name, '#', '_')) AS address, 'source.old_' || s_nationkey AS old FROM supplier
  UNION ALL SELECT 'u' || c_custkey, 'crosswalk.' || lower(c_mktsegment) || '_' || floor(c_acctbal)::BIGINT, NULL FROM customer),
places AS (SELECT uid, address, false AS old FROM entries UNION ALL SELECT uid, old, true FROM entries WHERE old IS NOT NULL)
SELECT 'uid.reused' AS rule, uid AS subject, count(DISTINCT address) AS claims, min(address) AS first, max(address) AS last
FROM entries GROUP BY uid HAVING count(DISTINCT address) > 1
UNION ALL SELECT CASE WHEN bool_or(old) THEN 'alias.repointed' ELSE 'address.shared' END, address, count(DISTINCT uid), min(uid), max(uid)
FROM places GROUP BY address HAVING count(DISTINCT uid) > 1""",
    "document_diff": " UNION ALL ".join(
        f"SELECT o_orderkey, '{pointer}' AS pointer, '{finding}' AS finding, {e} AS expected, {a} AS actual FROM orders WHERE {where}"
        for pointer, (where, finding, e, a) in DIFFS.items()
    ),
    "violation_report": f"""SELECT package, resource, rule, count(*) AS findings FROM (
  SELECT package, resource, rule FROM ({FIELD_SET})
  UNION ALL SELECT package, resource, rule FROM ({TYPES})
  UNION ALL SELECT package, resource, rule FROM ({FOREIGN_KEYS})
  UNION ALL SELECT package, resource, rule FROM ({constraint_findings()})
  UNION ALL SELECT package, resource, rule FROM ({PRIMARY_KEYS})
  UNION ALL SELECT 'catalogue', dataset, finding FROM ({CATALOGUE}) WHERE finding IS NOT NULL
) GROUP BY ALL""",
}
