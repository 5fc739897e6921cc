"""Nested records derived from the driver tables, and the jobs that turn them into rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from refloom.catalog import query
from refloom.functions.text import fill
from refloom.operators import aggregate as agg
from refloom.operators.nested import dimension, explode_children, explode_json, explode_self
from refloom.plans import adverse_events, applications, articles, medicines, substances, works
from refloom.schemas import APPLICATION, APPLICATION_LISTS, ARTICLE, MOLECULE, REPORT_COLUMNS, SAFETY_REPORT, SUBSTANCE, TARGET, WORK
from refloom.session import materialize, spread

LINE_ORDER = [
    "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]
LINE_SQL = ", ".join(LINE_ORDER)


def text(name):
    return F.col(name).cast("string")


def json_lists(t, **entries):
    """Orders with one JSON list text per entry, made of their line items in order."""
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    children = [agg.Child(name, lines, value, LINE_ORDER) for name, value in entries.items()]
    rows = agg.nested_master(spread(t.orders), ["o_orderkey"], children)
    joined = {n: F.concat(F.lit("["), F.array_join(n, ","), F.lit("]")) for n in entries}
    return rows.withColumns(joined)


def parse(df, doc, schema, *keep):
    """JSON texts to records."""
    return df.select(*keep, F.from_json(doc, schema).alias("r")).select(*keep, "r.*")


# Safety reports.


#: Report columns that stand on top of a record and hold a text of the customer here.
PLAIN_REPORT = [c for c in REPORT_COLUMNS if c not in ("safetyreportid", "serious", "receivedate", "companynumb") and c not in adverse_events.NESTED_REPORT]


def _reports(t):
    brand = F.when(F.col("l_returnflag") == "A", fill('["B%s"," ","C%s"]', text("l_partkey"), text("l_suppkey"))).otherwise(
        fill('"B%s"', text("l_partkey"))
    )
    drug = fill(
        '{"drugcharacterization":"%s","medicinalproduct":" part %s ","openfda":{"brand_name":%s}}',
        F.col("l_returnflag"), text("l_partkey"), brand,
    )
    reaction = fill('{"reactionmeddrapt":"%s"}', F.when(F.col("l_linestatus") == "F", F.lit(" ")).otherwise(F.concat(F.lit("pain "), text("l_linenumber"))))
    rows = json_lists(t, drugs=drug, reactions=reaction)
    patient = F.when(F.col("drugs") == "[]", F.lit("null")).otherwise(fill(
        '{"patientonsetage":"%s","patientonsetageunit":"801","patientsex":"%s","patientdeath":%s,"drug":%s,"reaction":%s}', (F.col("o_orderkey") % 90).cast("string"), F.col("o_orderpriority"),
        F.when(F.col("o_orderstatus") == "F", F.lit('{"patientdeathdate":"20200101"}')).otherwise("null"), F.col("drugs"), F.col("reactions"),
    ))
    plain = "".join(f',"{c}":"{c}-%s"' for c in PLAIN_REPORT)
    source = F.when(F.col("o_orderstatus") == "O", F.lit("null")).otherwise(fill('{"reportercountry":"C%s"}', (F.col("o_custkey") % 5).cast("string")))
    doc = fill(
        '{"safetyreportid":"%s","serious":%s,"receivedate":"%s","companynumb":"CO-%s","primarysource":%s,"sender":{"senderorganization":"Org %s"},"patient":%s' + plain + "}",
        text("o_orderkey"), F.when(F.col("o_orderstatus") == "P", F.lit("null")).otherwise(F.lit('"1"')),
        F.date_format("o_orderdate", "yyyyMMdd"), text("o_custkey"), source, text("o_custkey"), patient, *[text("o_custkey")] * len(PLAIN_REPORT),
    )
    # Nested records are written once; each table then reads only the fields it needs.
    return spread(materialize(parse(rows, doc, SAFETY_REPORT), "reports"))


@query(
    "normalize_reports",
    f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS safetyreportid, CASE WHEN o_orderstatus = 'P' THEN '' ELSE '1' END AS serious,
      {", ".join(f"'{c}-' || o_custkey AS {c}" for c in PLAIN_REPORT)},
      strftime(o_orderdate, '%Y%m%d') AS receivedate, 'CO-' || o_custkey AS companynumb, 'Org ' || o_custkey AS senderorganization,
      CASE WHEN o_orderstatus = 'O' THEN '' ELSE 'C' || o_custkey % 5 END AS reportercountry,
      CASE WHEN l IS NULL THEN '' ELSE CAST(o_orderkey % 90 AS VARCHAR) END AS patient_age, CASE WHEN l IS NULL THEN '' ELSE '801' END AS patient_age_unit,
      CASE WHEN l IS NULL THEN '' ELSE o_orderpriority END AS patient_sex,
      CASE WHEN l IS NOT NULL AND o_orderstatus = 'F' THEN '20200101' ELSE '' END AS patient_death_date
    FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey AS l FROM lineitem) ON o_orderkey = l
    """,
)
def normalize_reports(t):
    return adverse_events.tables(_reports(t))["reports"].select(*REPORT_COLUMNS)


@query(
    "normalize_1_to_3",
    """
    SELECT CAST(l_orderkey AS VARCHAR) AS safetyreportid, 'drug' AS side, 'part ' || l_partkey AS name, l_returnflag AS detail,
      CASE WHEN l_returnflag = 'A' THEN 'B' || l_partkey || ' | C' || l_suppkey ELSE 'B' || l_partkey END AS brands FROM lineitem
    UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 'reaction', 'pain ' || l_linenumber, '', '' FROM lineitem WHERE l_linestatus <> 'F'
    """,
)
def normalize_1_to_3(t):
    """Drug and reaction rows of the reports, under each other."""
    found = adverse_events.tables(_reports(t))
    drugs = found["drugs"].select(
        "safetyreportid", F.lit("drug").alias("side"), F.col("medicinalproduct").alias("name"),
        F.col("drugcharacterization").alias("detail"), F.col("openfda_brand_name").alias("brands"),
    )
    reactions = found["reactions"].select(
        "safetyreportid", F.lit("reaction").alias("side"), F.col("reactionmeddrapt").alias("name"), F.lit("").alias("detail"), F.lit("").alias("brands")
    )
    return drugs.unionByName(reactions)


@query(
    "case_search",
    """
    WITH ids AS (
      SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE CAST(o_orderkey AS VARCHAR) LIKE '%77%' OR 'co-' || o_custkey LIKE '%77%'
      UNION SELECT CAST(l_orderkey AS VARCHAR) FROM lineitem WHERE 'part ' || l_partkey LIKE '%77%' OR (l_returnflag = 'A' AND 'C' || l_suppkey LIKE '%77%')
        OR 'B' || l_partkey LIKE '%77%')
    SELECT id AS safetyreportid, (SELECT count(*) FROM lineitem WHERE CAST(l_orderkey AS VARCHAR) = id) AS n_drugs,
      (SELECT count(*) FROM lineitem WHERE CAST(l_orderkey AS VARCHAR) = id AND l_linestatus <> 'F') AS n_reactions
    FROM ids ORDER BY id LIMIT 5
    """,
)
def case_search(t):
    found = {name: materialize(df, name) for name, df in adverse_events.tables(_reports(t)).items()}
    cases = adverse_events.search(found, "77")
    sizes = [F.json_array_length(c).cast("long").alias(f"n_{c}") for c in ("drugs", "reactions")]
    return cases.select("safetyreportid", *sizes)


@query(
    "report_versions",
    """
    SELECT CAST(o_custkey AS VARCHAR) AS safetyreportid, strftime(max(o_orderdate), '%Y%m%d') AS receivedate FROM orders GROUP BY o_custkey
    """,
)
def report_versions(t):
    """Customers as report ids with a version per order: the last one received stays."""
    reports = t.orders.select(
        text("o_custkey").alias("safetyreportid"), F.lit("").alias("receiptdate"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("receivedate"), F.lit("").alias("transmissiondate"),
    )
    return adverse_events.latest_versions(reports).select("safetyreportid", "receivedate")


# Applications.


#: Identifier lists of an application that hold two texts here; one comes as a plain text, and one is missing.
LISTED = {out: src for out, src in APPLICATION_LISTS.items() if src not in ("generic_name", "rxcui", "pharm_class_pe")}


def _applications(t):
    product = fill(
        '{"product_number":"%s","brand_name":"Brand %s","reference_drug":"Yes","dosage_form":" F%s ","route":"ORAL","marketing_status":"%s","active_ingredients":[{"name":"part %s"%s},{"name":"water"}]}',
        text("l_linenumber"), text("l_suppkey"), text("l_linenumber"), F.col("l_linestatus"), text("l_partkey"),
        F.when(F.col("l_returnflag") == "N", F.lit("")).otherwise(fill(',"strength":"%s mg"', F.col("l_quantity").cast("long").cast("string"))),
    )
    submission = fill(
        '{"submission_type":"%s","submission_number":"%s","submission_status":"AP","submission_status_date":"%s","application_docs":[{"type":"Label","url":"%s","date":"2020"}]}',
        F.col("l_linestatus"), text("l_linenumber"), F.date_format("l_shipdate", "yyyyMMdd"),
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("http://h/"), text("l_suppkey"))).otherwise(""),
    )
    rows = json_lists(t, products=product, submissions=submission)
    lists = "".join(f',"{src}":["{src}-%s","z"]' for src in LISTED.values())
    doc = fill(
        '{"application_number":"NDA%s","sponsor_name":"%s","openfda":{"generic_name":["%s"," x "],"rxcui":"R%s"' + lists + '},"products":%s,"submissions":%s}',
        text("o_orderkey"), F.col("o_orderpriority"), F.col("o_orderstatus"), text("o_custkey"), *[text("o_custkey")] * len(LISTED),
        F.col("products"), F.col("submissions"),
    )
    return spread(materialize(parse(rows, doc, APPLICATION), "applications"))


@query(
    "explode_outer_flatten",
    f"""
    WITH s AS (
      SELECT l_orderkey,
        string_agg(l_linestatus || '(' || l_linenumber || ') - AP (' || strftime(l_shipdate, '%Y-%m-%d') || ')', ' | ' ORDER BY {LINE_SQL}) AS submissions,
        string_agg('Label (2020): http://h/' || l_suppkey, ' | ' ORDER BY {LINE_SQL}) FILTER (WHERE l_returnflag = 'R') AS docs
      FROM lineitem GROUP BY l_orderkey)
    SELECT 'NDA' || o_orderkey AS application_number, o_orderpriority AS sponsor_name, o_orderstatus || ' | x' AS openfda_generic_names,
      'R' || o_custkey AS openfda_rxcuis, '' AS openfda_pharm_class_pe, {", ".join(f"'{src}-' || o_custkey || ' | z' AS {out}" for out, src in LISTED.items())},
      coalesce(CAST(l_linenumber AS VARCHAR), '') AS product_number, coalesce('Brand ' || l_suppkey, '') AS brand_name,
      CASE WHEN l.l_orderkey IS NULL THEN '' ELSE 'Yes' END AS reference_drug, '' AS reference_standard, coalesce('F' || l_linenumber, '') AS dosage_form,
      CASE WHEN l.l_orderkey IS NULL THEN '' ELSE 'ORAL' END AS route, coalesce(l_linestatus, '') AS marketing_status,
      coalesce('part ' || l_partkey || CASE WHEN l_returnflag = 'N' THEN '' ELSE ' (' || CAST(l_quantity AS BIGINT) || ' mg)' END || ' | water', '') AS active_ingredients,
      coalesce(submissions, '') AS submissions, coalesce(docs, '') AS application_docs
    FROM orders LEFT JOIN lineitem l ON o_orderkey = l.l_orderkey LEFT JOIN s ON o_orderkey = s.l_orderkey
    """,
)
def explode_outer_flatten(t):
    return applications.flatten(_applications(t))


@query(
    "application_search",
    """
    SELECT 'NDA' || o_orderkey AS application_number FROM orders WHERE o_orderpriority ILIKE '%part 12%' OR o_orderkey IN
      (SELECT l_orderkey FROM lineitem WHERE 'part ' || l_partkey LIKE '%part 12%') ORDER BY application_number LIMIT 5
    """,
)
def application_search(t):
    return applications.search(_applications(t), "PART 12").select("application_number")


@query(
    "explode_children",
    "SELECT o_orderkey, l_linenumber FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey",
)
def children_rows(t):
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    nested = agg.nested_master(t.orders.select("o_orderkey"), ["o_orderkey"], [agg.Child("items", lines, F.struct("l_linenumber"), LINE_ORDER)])
    return explode_children(nested, "items", "x").select("o_orderkey", "x.l_linenumber")


# Works.


def _works(t):
    author = fill(
        '{"author_position":"a%s","author":{"id":%s,"display_name":"Author %s"},"institutions":[{"id":"I%s","display_name":"Inst %s","country_code":"%s"}]}',
        text("l_linenumber"), F.when(F.col("l_returnflag") == "N", F.lit("null")).otherwise(fill('"A%s"', text("l_partkey"))),
        text("l_partkey"), text("l_suppkey"), text("l_suppkey"), F.col("l_linestatus"),
    )
    rows = json_lists(t, authorships=author)
    doc = fill(
        '{"id":"%s","title":"Order %s","publication_year":%s,"doi":"10/%s","publication_date":"%s","type":"article","language":"en","cited_by_count":%s,"updated_date":"2024","primary_topic":{"display_name":"T%s","field":{"display_name":"F"},"domain":null},"mesh":[{"descriptor_name":"D%s","qualifier_name":null,"is_major_topic":true},{"descriptor_name":"E","qualifier_name":"q","is_major_topic":false}],"primary_location":{"source":{"id":"S%s","display_name":"J %s","host_organization_name":"P","issn":["1-%s"]}},"open_access":{"is_oa":%s,"oa_status":"gold","oa_url":"http://o/%s"},"authorships":%s,"funders":[{"display_name":"%s"},{"display_name":"%s"}],"abstract_inverted_index":{"status":[0,3],"is":[1],"%s":[2]}}',
        F.lpad(text("o_orderkey"), 9, "0"), text("o_orderkey"), F.date_format("o_orderdate", "yyyy"), text("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd"),
        text("o_custkey"), F.col("o_orderstatus"), F.col("o_orderstatus"), F.date_format("o_orderdate", "yyyyMM"), F.date_format("o_orderdate", "yyyyMM"),
        F.date_format("o_orderdate", "MM"), (F.col("o_orderstatus") == "F").cast("string"), text("o_orderkey"), F.col("authorships"),
        F.col("o_orderpriority"), F.col("o_orderpriority"), F.col("o_orderstatus"),
    )
    return spread(materialize(parse(rows, doc, WORK), "works"))


@query(
    "flat_works",
    f"""
    WITH x AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_SQL}) AS i FROM lineitem),
    a AS (SELECT l_orderkey, string_agg('Author ' || l_partkey, '; ' ORDER BY i) AS authors, first('Inst ' || l_suppkey ORDER BY i) AS first_inst FROM x GROUP BY 1),
    s AS (SELECT l_orderkey, string_agg('Inst ' || l_suppkey, '; ' ORDER BY i) AS institutions FROM (SELECT l_orderkey, l_suppkey, min(i) AS i FROM x GROUP BY 1, 2) GROUP BY 1),
    c AS (SELECT l_orderkey, string_agg(l_linestatus, '; ' ORDER BY i) AS countries FROM (SELECT l_orderkey, l_linestatus, min(i) AS i FROM x GROUP BY 1, 2) GROUP BY 1)
    SELECT lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS work_id, 'Order ' || o_orderkey AS title, CAST(year(o_orderdate) AS INTEGER) AS publication_year,
      '1-' || strftime(o_orderdate, '%m') AS issn, o_orderstatus = 'F' AS is_oa, coalesce(authors, '') AS authors, coalesce(first_inst, '') AS first_author_institution,
      coalesce(institutions, '') AS institutions, coalesce(countries, '') AS countries, o_orderpriority AS funders, 'status is ' || o_orderstatus || ' status' AS abstract,
      '10/' || o_orderkey AS doi, strftime(o_orderdate, '%Y-%m-%d') AS publication_date, 'article' AS type, 'en' AS language, 'J ' || strftime(o_orderdate, '%Y%m') AS journal_name,
      'P' AS publisher, 'gold' AS oa_status, 'http://o/' || o_orderkey AS oa_url, CAST(o_custkey AS BIGINT) AS cited_by_count, 'T' || o_orderstatus AS primary_topic,
      'F' AS primary_topic_field, '' AS primary_topic_domain, 'D' || o_orderstatus || '; E/q' AS mesh_terms, 'D' || o_orderstatus AS major_mesh_terms, '2024' AS updated_date
    FROM orders LEFT JOIN a ON a.l_orderkey = o_orderkey LEFT JOIN s ON s.l_orderkey = o_orderkey LEFT JOIN c ON c.l_orderkey = o_orderkey
    """,
)
def flat_works(t):
    return works.flat(_works(t))


@query(
    "star_split",
    f"""
    WITH w AS (SELECT *, lpad(CAST(l_orderkey AS VARCHAR), 9, '0') AS work_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_SQL}) AS i FROM lineitem)
    SELECT 'author' AS side, 'A' || l_partkey AS id, 'Author ' || l_partkey AS name, '' AS detail FROM w WHERE l_returnflag <> 'N' GROUP BY l_partkey
    UNION ALL SELECT 'institution', 'I' || l_suppkey, 'Inst ' || l_suppkey, first(l_linestatus ORDER BY work_id, i) FROM w GROUP BY l_suppkey
    UNION ALL SELECT DISTINCT 'source', 'S' || strftime(o_orderdate, '%Y%m'), 'J ' || strftime(o_orderdate, '%Y%m'), '1-' || strftime(o_orderdate, '%m') FROM orders
    UNION ALL SELECT 'affiliation', work_id || ' A' || l_partkey || ' I' || l_suppkey, first('a' || l_linenumber ORDER BY i), '' FROM w
      WHERE l_returnflag <> 'N' GROUP BY work_id, l_partkey, l_suppkey
    """,
)
def star_split(t):
    """The four tables around the works, under each other."""
    found = works.relations(_works(t))
    shaped = [
        found["authors"].select(F.lit("author").alias("side"), F.col("author_id").alias("id"), F.col("display_name").alias("name"), F.lit("").alias("detail")),
        found["institutions"].select(F.lit("institution"), "institution_id", "display_name", "country_code"),
        found["sources"].select(F.lit("source"), "source_id", "display_name", "issn"),
        found["affiliations"].select(F.lit("affiliation"), F.concat_ws(" ", "work_id", "author_id", "institution_id"), "author_position", F.lit("")),
    ]
    return shaped[0].union(shaped[1]).union(shaped[2]).union(shaped[3])


@query(
    "dimension_first",
    f"""
    SELECT l_suppkey, first(l_orderkey ORDER BY l_orderkey, {LINE_SQL}) AS l_orderkey, first(l_returnflag ORDER BY l_orderkey, {LINE_SQL}) AS l_returnflag
    FROM lineitem GROUP BY l_suppkey
    """,
)
def dimension_first(t):
    return dimension(t.lineitem, ["l_suppkey"], ["l_orderkey", "l_returnflag"], ["l_orderkey", *LINE_ORDER])


# Articles.


def _articles(t):
    author = fill(
        '{"fullName":%s,"lastName":"L%s","authorId":{"type":"%s","value":"0-%s"},"authorAffiliationDetailsList":{"authorAffiliation":[{"affiliation":" Inst %s "}]}}',
        F.when(F.col("l_linestatus") == "F", F.lit("null")).otherwise(fill('"Full %s"', text("l_partkey"))), text("l_partkey"),
        F.when(F.col("l_returnflag") == "A", F.lit("ORCID")).otherwise("OTHER"), text("l_partkey"), text("l_suppkey"),
    )
    grant = fill('{"agency":"Ag %s","grantId":"%s"}', F.col("l_returnflag"), text("l_linenumber"))
    chemical = fill('{"name":"part %s","registryNumber":"%s"}', text("l_partkey"), F.when(F.col("l_returnflag") == "R", text("l_suppkey")).otherwise("0"))
    rows = json_lists(t, authors=author, grants=grant, chemicals=chemical)
    kinds = F.when(F.col("o_orderstatus") == "F", F.lit('"review"')).when(F.col("o_orderstatus") == "O", F.lit('["review","trial"]')).otherwise(
        F.lit('[{"pubType":"review"},{"pubType":"case"}]')
    )
    doc = fill(
        '{"id":"%s","pmcid":%s,"isOpenAccess":"%s","authorString":"Many","authorList":{"author":%s},"grantsList":{"grant":%s},"chemicalList":{"chemical":%s},"journalTitle":"J","pubTypeList":{"pubType":%s},"fullTextUrlList":{"fullTextUrl":[{"url":"http://h/%s","site":"S"},{"site":"none"}]}}',
        text("o_orderkey"), F.when(F.col("o_orderstatus") == "P", F.lit("null")).otherwise(fill('"PMC%s"', text("o_orderkey"))),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("Y")).otherwise("N"), F.col("authors"), F.col("grants"), F.col("chemicals"), kinds, text("o_orderkey"),
    )
    return parse(rows, doc, ARTICLE)


@query(
    "article_metadata",
    f"""
    WITH a AS (
      SELECT l_orderkey, string_agg(CASE WHEN l_linestatus = 'F' THEN 'L' ELSE 'Full ' END || l_partkey, '; ' ORDER BY {LINE_SQL}) AS authors,
        string_agg('0-' || l_partkey, '; ' ORDER BY {LINE_SQL}) FILTER (WHERE l_returnflag = 'A') AS orcids,
        string_agg('Ag ' || l_returnflag || ' (ID: ' || l_linenumber || ')', '; ' ORDER BY {LINE_SQL}) AS grants,
        string_agg('part ' || l_partkey || ' (' || l_suppkey || ')', '; ' ORDER BY {LINE_SQL}) FILTER (WHERE l_returnflag = 'R' AND l_suppkey <> 0) AS numbers
      FROM lineitem GROUP BY l_orderkey),
    i AS (SELECT l_orderkey, string_agg(x, '; ' ORDER BY x) AS homes FROM (SELECT DISTINCT l_orderkey, 'Inst ' || l_suppkey AS x FROM lineitem) GROUP BY 1)
    SELECT CAST(o_orderkey AS VARCHAR) AS id, coalesce(authors, 'Many') AS authors, coalesce(orcids, '') AS author_orcids, coalesce(homes, '') AS author_affiliations,
      'J' AS journal_title, CASE o_orderstatus WHEN 'F' THEN 'review' WHEN 'O' THEN 'review; trial' ELSE 'review; case' END AS pub_type,
      '[S link] http://h/' || o_orderkey AS full_text_urls, coalesce(grants, '') AS grants, coalesce(numbers, '') AS chemical_registry_numbers
    FROM orders LEFT JOIN a ON a.l_orderkey = o_orderkey LEFT JOIN i ON i.l_orderkey = o_orderkey
    """,
)
def article_metadata(t):
    return articles.metadata(_articles(t), extended=True).select(
        "id", "authors", "author_orcids", "author_affiliations", "journal_title", "pub_type", "full_text_urls", "grants", "chemical_registry_numbers"
    )


@query(
    "extraction_queue",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority = '1-URGENT'
      AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A')
    """,
)
def extraction_queue(t):
    done = t.lineitem.filter("l_returnflag = 'A'").select(text("l_orderkey").alias("id"))
    return articles.extraction_queue(_articles(t), done)


# Substances and compounds.


@query(
    "substance_rows",
    f"""
    WITH x AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_SQL}) AS i FROM lineitem),
    c AS (SELECT l_orderkey, string_agg('S' || l_suppkey, '|' ORDER BY i) AS cas FROM (SELECT l_orderkey, l_suppkey, min(i) AS i FROM x WHERE l_returnflag = 'A' GROUP BY 1, 2) GROUP BY 1),
    n AS (SELECT l_orderkey, string_agg('L' || l_linenumber, '|' ORDER BY i) AS syn FROM (SELECT l_orderkey, l_linenumber, min(i) AS i FROM x WHERE l_linenumber <> 3 GROUP BY 1, 2) GROUP BY 1)
    SELECT CAST(o_orderkey AS VARCHAR) AS uuid, 'l3' AS preferred_name, o_orderstatus = 'F' AS deprecated, coalesce(cas, '') AS cas_number, coalesce(syn, '') AS synonyms
    FROM orders LEFT JOIN c ON c.l_orderkey = o_orderkey LEFT JOIN n ON n.l_orderkey = o_orderkey
    """,
)
def substance_rows(t):
    """Line numbers as names, suppliers as registry codes; the preferred name differs only in case from one of them."""
    code = fill('{"codeSystem":"%s","code":" S%s"}', F.when(F.col("l_returnflag") == "A", "CAS").otherwise("X"), text("l_suppkey"))
    rows = json_lists(t, codes=code, names=fill('{"name":"L%s"}', text("l_linenumber")))
    doc = fill(
        '{"uuid":"%s","_name":" l3 "%s,"codes":%s,"names":%s}', text("o_orderkey"),
        F.when(F.col("o_orderstatus") == "F", F.lit(',"deprecated":true')).otherwise(""), F.col("codes"), F.col("names"),
    )
    return substances.registrations(parse(rows, doc, SUBSTANCE)).select("uuid", "preferred_name", "deprecated", "cas_number", "synonyms")


@query(
    "compound_rows",
    """
    WITH s AS (SELECT l_orderkey, string_agg(x, '|' ORDER BY x) AS names FROM (SELECT DISTINCT l_orderkey, 'P' || l_partkey AS x FROM lineitem) GROUP BY 1)
    SELECT 'M' || o_orderkey AS id, 'molecule' AS side, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE '12.5' END AS detail, coalesce(names, '') AS names
      FROM orders LEFT JOIN s ON l_orderkey = o_orderkey
    UNION ALL SELECT 'T' || o_orderkey, 'target', 'Homo sapiens', coalesce(names, '') FROM orders LEFT JOIN s ON l_orderkey = o_orderkey
    """,
)
def compound_rows(t):
    """Molecules with synonyms and targets with accessions out of the same lines."""
    syn = fill('{"molecule_synonym":"P%s"}', text("l_partkey"))
    acc = fill('{"accession":"P%s"}', text("l_partkey"))
    rows = json_lists(t, syn=syn, acc=acc)
    properties = F.when(F.col("o_orderstatus") == "P", F.lit("null")).otherwise(F.lit('{"mw_freebase":"12.5"}'))
    molecule = fill(
        '{"chembl_id":"M%s","molecule_properties":%s,"molecule_synonyms":%s}', text("o_orderkey"), properties, F.col("syn")
    )
    target = fill('{"target_chembl_id":"T%s","organism":"Homo sapiens","target_components":%s}', text("o_orderkey"), F.col("acc"))
    left = substances.molecules(parse(rows, molecule, MOLECULE)).select(
        F.col("chembl_id").alias("id"), F.lit("molecule").alias("side"), F.col("mw_freebase").alias("detail"), F.col("synonyms").alias("names")
    )
    right = substances.targets(parse(rows, target, TARGET)).select("target_chembl_id", F.lit("target"), "organism", "accessions")
    return left.union(right)


@query(
    "activity_rows",
    "SELECT CAST(event_id AS VARCHAR) AS activity_id, event_type AS type, CAST(NULL AS VARCHAR) AS units FROM events",
)
def activity_rows(t):
    raw = t.events.select(text("event_id").alias("activity_id"), F.col("event_type").alias("type"), F.lit("x").alias("not_declared"))
    return substances.activities(raw).select("activity_id", "type", "units")


@query(
    "activity_pages",
    """
    SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS activity_id, 'M' || l_partkey AS molecule_chembl_id, 'T' || l_suppkey AS target_chembl_id,
      CAST(NULL AS VARCHAR) AS assay_chembl_id, l_returnflag AS type, CASE WHEN l_linenumber < 4 THEN '=' ELSE '>' END AS relation,
      CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS value, 'nM' AS units, CASE l_linestatus WHEN 'O' THEN 'open' END AS canonical_data_validity_comment,
      'D' || l_orderkey AS document_chembl_id, 'U' AS uo_units, lower(l_returnflag) AS standard_type, '=' AS standard_relation,
      CAST(l_linenumber AS VARCHAR) AS standard_value, CAST(NULL AS VARCHAR) AS standard_units
    FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber < 4
    """,
)
def activity_pages(t):
    """A reply page of activities per order: all columns, of one type in any case and one relation."""
    def number(c):
        return F.col(c).cast("string")

    def named(prefix, c):
        return F.concat(F.lit(prefix), number(c))

    activity = F.struct(
        F.concat_ws("-", *map(number, ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))).alias("activity_id"),
        named("M", "l_partkey").alias("molecule_chembl_id"), named("T", "l_suppkey").alias("target_chembl_id"),
        F.col("l_returnflag").alias("type"), F.when(F.col("l_linenumber") < 4, "=").otherwise(">").alias("relation"),
        number("l_quantity").cast("double").cast("long").alias("value"), F.lit("nM").alias("units"),
        F.when(F.col("l_linestatus") == "O", "open").alias("canonical_data_validity_comment"), named("D", "l_orderkey").alias("document_chembl_id"),
        F.lit("U").alias("uo_units"), F.lower("l_returnflag").alias("standard_type"), F.lit("=").alias("standard_relation"),
        F.col("l_linenumber").alias("standard_value"), F.lit("not declared").alias("other"),
    )
    replies = t.lineitem.groupBy("l_orderkey").agg(F.to_json(F.struct(F.collect_list(activity).alias("activities"), F.lit(1).alias("page_meta"))).alias("payload"))
    return substances.activity_pages(replies, kind="r", relation="=")


# JSON lists in text, and components.


@query(
    "explode_json",
    f"""
    SELECT user_id, event_id, k, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS item_pos FROM (
      SELECT user_id, event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
      WHERE user_id % 10 <> 3)
    """,
)
def explode_json_rows(t):
    """Properties of a user as one JSON list; the list of every tenth user is broken and skipped."""
    item = F.concat(F.substring("props", F.lit(1), F.length("props") - 1), F.lit(', "event_id": '), text("event_id"), F.lit("}"))
    lists = agg.ordered_list(t.events, ["user_id"], item, ["event_id"], "items")
    body = F.concat(F.lit("["), F.array_join("items", ","))
    rows = lists.select("user_id", F.when(F.col("user_id") % 10 == 3, body).otherwise(F.concat(body, F.lit("]"))).alias("doc"))
    return explode_json(rows, "doc", "array<struct<k: long, event_id: long>>", ["user_id"]).withColumn("item_pos", F.col("item_pos").cast("long"))


@query(
    "explode_self",
    """
    SELECT p_partkey, p_name, CASE WHEN p_type = 'PROMO' THEN p_name WHEN p_type = 'LARGE' THEN NULL ELSE x END AS component
    FROM part, LATERAL (SELECT unnest(CASE WHEN p_type IN ('PROMO', 'LARGE') THEN [''] ELSE string_split(p_name, ' ') END) AS x)
    """,
)
def explode_self_rows(t):
    related = F.when(F.col("p_type") != "LARGE", F.split("p_name", " "))
    return explode_self(t.part, F.col("p_type") == "PROMO", F.col("p_name"), related, ["p_partkey", "p_name"], "component")


# Medicine dossiers.


@query(
    "dossier",
    """
    WITH e AS (
      SELECT 'M' || o_custkey AS medicine_name, CAST(o_custkey AS VARCHAR) AS ema_product_number, lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS document_url,
        CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE 'made of ' || o_orderkey END AS composition,
        'N' || month(o_orderdate) || ', N' || (month(o_orderdate) + 1) AS ncts, 'NCT' || year(o_orderdate) AS nct_id, 'T' || month(o_orderdate) AS brief_title
      FROM orders WHERE o_orderstatus <> 'P'),
    p AS (SELECT medicine_name, ema_product_number, first(composition ORDER BY document_url) FILTER (WHERE composition <> '') AS composition FROM e GROUP BY 1, 2),
    n AS (SELECT medicine_name, string_agg(x, ',' ORDER BY x) AS nct_numbers FROM (SELECT DISTINCT medicine_name, trim(unnest(string_split(ncts, ','))) AS x FROM e) GROUP BY 1)
    SELECT p.medicine_name, ema_product_number, 'substance ' || ema_product_number AS active_substance, composition, nct_numbers FROM p JOIN n ON p.medicine_name = n.medicine_name
    """,
)
def dossier_profiles(t):
    return medicines.profiles(_extractions(t)).select(
        "medicine_name", "ema_product_number", "active_substance", "composition", "nct_numbers"
    )


@query(
    "dossier_trials",
    """
    WITH RECURSIVE e AS (
      SELECT 'M' || o_custkey AS medicine_name, o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE 'made of ' || o_orderkey END AS composition,
        'NCT' || year(o_orderdate) AS nct_id, 'T' || month(o_orderdate) AS brief_title, o_orderstatus AS phase, o_orderpriority FROM orders WHERE o_orderstatus <> 'P'),
    p AS (SELECT medicine_name, first(composition ORDER BY o_orderkey) FILTER (WHERE composition <> '') AS composition FROM e GROUP BY 1),
    t AS (SELECT *, row_number() OVER (PARTITION BY medicine_name ORDER BY o_orderkey) AS n FROM e WHERE o_orderpriority <> '1-URGENT'),
    r AS (
      SELECT DISTINCT medicine_name, CAST(0 AS BIGINT) AS n, false AS ok, CAST([] AS VARCHAR[]) AS a, CAST([] AS VARCHAR[]) AS b FROM t
      UNION ALL
      SELECT medicine_name, n, ok, CASE WHEN ok THEN list_append(a, nct_id) ELSE a END, CASE WHEN ok THEN list_append(b, brief_title) ELSE b END
      FROM (
        SELECT t.medicine_name, t.n, a, b, nct_id, brief_title, NOT list_contains(a, nct_id) AND NOT list_contains(b, brief_title) AS ok
        FROM r JOIN t ON t.medicine_name = r.medicine_name AND t.n = r.n + 1)),
    k AS (SELECT t.* FROM t JOIN r ON t.medicine_name = r.medicine_name AND t.n = r.n WHERE ok)
    SELECT p.medicine_name, p.composition, nct_id, brief_title, phase FROM p LEFT JOIN k ON k.medicine_name = p.medicine_name
    """,
)
def dossier_trials(t):
    """Dossier rows with the trials that remain after number-or-title deduplication in document order."""
    return medicines.dossier(_extractions(t)).select("medicine_name", "composition", "nct_id", "brief_title", "phase")


def _extractions(t):
    month = F.month("o_orderdate")
    trials = fill(
        '[{"nct_id":"NCT%s","brief_title":"T%s","phase":"%s"}]', F.year("o_orderdate").cast("string"), month.cast("string"), F.col("o_orderstatus")
    )
    rows = t.orders.select(
        F.concat(F.lit("M"), text("o_custkey")).alias("medicine_name"), text("o_custkey").alias("ema_product_number"),
        F.lpad(text("o_orderkey"), 9, "0").alias("document_url"), F.lit("overview").alias("document_type"),
        F.when(F.col("o_orderstatus") == "P", "failed").otherwise("completed").alias("extraction_status"),
        F.concat(F.lit("N"), month.cast("string"), F.lit(", N"), (month + 1).cast("string")).alias("nct_numbers"),
        F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(F.concat(F.lit("made of "), text("o_orderkey"))).alias("composition"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("[{broken")).otherwise(trials).alias("clinical_trials_json"),
        *[F.lit(None).cast("string").alias(c) for c in medicines.DOSSIER_TEXT_COLUMNS if c != "composition"],
    )
    number = text("c_custkey")
    master = t.customer.select(
        number.alias("ema_product_number"), F.concat(F.lit("substance "), number).alias("active_substance"),
        *[F.lit(None).cast("string").alias(c) for c in medicines.DOSSIER_MASTER_COLUMNS if c != "active_substance"],
    )
    return materialize(medicines.extraction_base(rows, master), "extractions")


@query(
    "pending_documents",
    """
    SELECT o_orderkey AS document_url, c_custkey AS ema_product_number, o_orderpriority FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_orderstatus = 'F' AND c_mktsegment <> 'BUILDING' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
    """,
)
def pending_documents(t):
    downloads = t.orders.select(F.col("o_orderkey").alias("document_url"), F.when(F.col("o_orderstatus") == "F", "completed").otherwise("pending").alias("status"))
    documents = t.orders.select(F.col("o_orderkey").alias("document_url"), F.col("o_custkey").alias("ema_product_number"), "o_orderpriority")
    meds = t.customer.filter("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("ema_product_number"))
    extracted = t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("document_url"))
    return medicines.pending_documents(downloads, documents, meds, extracted).select("document_url", "ema_product_number", "o_orderpriority")
