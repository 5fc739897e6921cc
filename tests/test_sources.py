"""Files as the sources deliver them, with their odd rows."""

import gzip
import json
import zipfile

from conftest import rows
from pyspark.sql import functions as F

from refloom.plans import drug_products, drug_records
from refloom.schemas import DRUG_PRODUCT_FILES
from refloom.sources import archives, delimited, documents, sinks


def put(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_positional(spark, tmp_path):
    put(tmp_path / "m" / "schedule.txt", '"1","OTC, all","VL"\n"2","Rx"\n\n')
    put(tmp_path / "c" / "schedule_ia.txt", '"3","He said ""no""","x","y","z"\n')
    put(tmp_path / "c" / "route_ia.txt", '"3","1","Oral","Orale"\n')
    folders = {"marketed": str(tmp_path / "m"), "cancelled": str(tmp_path / "c")}
    got = delimited.read_positional(spark, folders, "schedule", DRUG_PRODUCT_FILES, "status")
    assert rows(got) == [
        ("1", "OTC, all", "VL", "marketed"), ("2", "Rx", None, "marketed"), ("3", 'He said "no"', "x", "cancelled"),
    ]


def test_drug_master(spark, tmp_path):
    files = {
        "drug": '"1","","HUMAN","00001","A"\n"2","","HUMAN","00002","B"\n',
        "ingred": '"1","9","ZINC","","5","MG"\n"1","8","ACID","","","MG"\n"1","7","IRON","","2","G"\n',
        "comp": '"1","","","ACME","OWNER"\n', "route": '"1","1","ORAL"\n"1","2","NASAL"\n', "form": "", "status": "",
        "ther": "", "schedule": "", "package": '"2","U1"\n', "vet": "", "pharm": "", "biosimilar": "",
    }
    for key, text in files.items():
        put(tmp_path / f"{key}.txt", text)
    tables = drug_products.load(spark, {"marketed": str(tmp_path)})
    got = {r.drug_code: r for r in drug_products.master(tables).collect()}
    # A missing strength is an empty CSV field, which reads as NULL and drops the ingredient from the text.
    assert got["1"].active_ingredients == "IRON (2 G); ZINC (5 MG)"
    assert got["1"].routes == "NASAL; ORAL" and got["1"].companies == "ACME (OWNER)" and got["2"].routes is None
    nested = {r.drug_code: r for r in drug_products.documents(tables).collect()}
    assert [i.ingredient_name_en for i in nested["1"].active_ingredients] == ["ACID", "IRON", "ZINC"]
    assert nested["2"].active_ingredients == [] and nested["2"].packaging[0].upc == "U1"
    assert drug_products.master(tables, by_status=True).count() == 2
    assert [r.drug_code for r in drug_products.search(tables, "zin").collect()] == ["1"]


def test_delimited(spark, tmp_path):
    path = put(tmp_path / "p.txt", "Ingredient~DF;Route~Trade_Name\n A ~x;y~ \"B\" \nC\nD~1~2~3\n\n")
    got = delimited.read_delimited(spark, path, "~")
    assert got.columns == ["Ingredient", "DF;Route", "Trade_Name"]
    assert rows(got) == [("A", "x;y", '"B"'), ("C", "", ""), ("D", "1", "2")]


def test_latin1_lines(spark, tmp_path):
    path = tmp_path / "l.txt"
    path.write_bytes("K~V\n1~café\n".encode("utf-8") + "2~naïve\n".encode("latin-1"))
    assert rows(delimited.read_delimited(spark, str(path), "~")) == [("1", "café"), ("2", "naïve")]


def test_folded_and_mapping(spark, tmp_path):
    from refloom.plans.concepts import thesaurus

    path = put(tmp_path / "t.txt", "C1\t<i>\tP\ta|b\tdef\td\ts\tt\tx\ty\nC2\t<i>\t\t| z\n")
    got = {r.code: r for r in thesaurus(spark, path).collect()}
    assert (got["C1"].preferred_name, got["C1"].concept_in_subsets) == ("a", "x|y")
    assert (got["C2"].preferred_name, got["C2"].definition) == ("z", "")
    path = put(tmp_path / "m.dat", "# note\nC1|CL1|\n\n|C2||CL2\nC3|\n")
    assert rows(delimited.read_mapping(spark, path, "|", ["a", "b"])) == [("C1", "CL1"), ("C2", "CL2")]


def test_bulk_gzip(spark, tmp_path):
    path = tmp_path / "CID-InChI-Key.gz"
    path.write_bytes(gzip.compress(b"1\tAAA\n2\n3\tBBB \n"))
    got = delimited.read_bulk_mapping(spark, str(path))
    assert got.columns == ["CID", "InChIKey"] and rows(got) == [("1", "AAA"), ("3", "BBB")]


def test_maybe_header(spark, tmp_path):
    with_header = delimited.read_maybe_header(spark, put(tmp_path / "a.txt", "Concept Code\t\tX\nC1\tn\tz\tw\n"))
    assert with_header.columns == ["Concept Code", "col_2", "X", "column_4"] and rows(with_header) == [("C1", "n", "z", "w")]
    bare = delimited.read_maybe_header(spark, put(tmp_path / "b.txt", "C1\tn\nC2\tm\tz\n"))
    assert bare.columns == ["ncit_code", "preferred_name", "column_3"] and rows(bare) == [("C1", "n", ""), ("C2", "m", "z")]


def test_sections(spark, tmp_path):
    text = "title,,\nApplicant,BLA Number,Name\nA,1,\"x, y\"\n,,\nBLA Number,Proprietary Name\n2,b\n\n3,c\n"
    is_header = F.contains("line", F.lit("Applicant,BLA Number")) | F.contains("line", F.lit("BLA Number,Proprietary Name"))
    found = delimited.read_sections(spark, put(tmp_path / "s.csv", text), is_header)
    first, second = delimited.section_table(found, 1), delimited.section_table(found, 2)
    assert first.columns == ["Applicant", "BLA Number", "Name"] and rows(first) == [("A", "1", "x, y")]
    assert second.columns == ["BLA Number", "Proprietary Name"] and rows(second) == [("2", "b"), ("3", "c")]


def test_lines_keep_their_order_over_splits(spark, tmp_path):
    path = put(tmp_path / "big.txt", "".join(f"line {i}\n" for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = delimited.read_lines(spark, path)
        assert found.select("block").distinct().count() > 3
        got = [r.line for r in found.orderBy("block", "seq").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [f"line {i}" for i in range(20_000)]


def test_results_and_zip(spark, tmp_path):
    path = put(tmp_path / "r.json", json.dumps({"results": [{"id": "1", "x": [1]}, {"id": "2"}]}, indent=1))
    assert rows(documents.read_results_json(spark, path, "id string, x array<int>")) == [("1", [1]), ("2", None)]
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("a.TXT", b"one\r\ncaf\xe9\n")
        z.writestr("b.md", "no")
    got = archives.read_zip_members(spark, str(tmp_path / "z.zip"), ".txt")
    assert rows(got, "member", "pos", "line") == [("a.TXT", 0, "one"), ("a.TXT", 1, "café")]
    whole = archives.read_zip_members(spark, str(tmp_path / "z.zip"), ".txt", raw=True)
    assert bytes(whole.head().content) == b"one\r\ncaf\xe9\n"


def test_archive_members_are_read_apart(spark, tmp_path):
    """A member per partition where they are large, several where they are small; as a stream, whatever the batch size is."""
    for k in range(3):
        with zipfile.ZipFile(tmp_path / f"{k}.zip", "w", zipfile.ZIP_STORED) as z:
            z.mkdir("dir.txt")
            for name, n in (("big.txt", 5_000), ("other.txt", 4_000), ("small.txt", 3), ("tiny.txt", 1), ("none.txt", 0)):
                z.writestr(f"in/{name}", "".join(f"{k} line {i}\r\n" for i in range(n)))
    found = archives.read_zip_members(spark, f"{tmp_path}/*.zip", ".TXT", partition_bytes=30_000)
    assert found.rdd.getNumPartitions() >= 6
    got = found.groupBy("archive", "member").agg(F.count("*").alias("n"), F.max("pos").alias("last"), F.max_by("line", "pos").alias("end")).collect()
    assert len(got) == 3 * 4
    for r in got:
        k = r.archive.rsplit("/", 1)[-1][0]
        n = {"in/big.txt": 5_000, "in/other.txt": 4_000, "in/small.txt": 3, "in/tiny.txt": 1}[r.member]
        assert (r.n, r.last, r.end) == (n, n - 1, f"{k} line {n - 1}")
    assert archives.read_zip_members(spark, f"{tmp_path}/*.zip", ".nothing").count() == 0
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        assert archives.read_zip_members(spark, f"{tmp_path}/0.zip", "big.txt").count() == 5_000
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")


def test_written_archives(spark, tmp_path):
    df = spark.createDataFrame([(f"m{k}.txt", f"a{k}\nb") for k in range(20)], "name string, content string").repartition(4)
    archives.write_archives(df, f"{tmp_path}/z", "name", "content")
    got = archives.read_zip_members(spark, f"{tmp_path}/z", ".txt")
    assert rows(got, "member", "line") == sorted([(f"m{k}.txt", x) for k in range(20) for x in (f"a{k}", "b")], key=repr)


def test_drug_xml_file(spark, tmp_path):
    text = """<?xml version="1.0"?><drugbank>
    <drug type="biotech"><drugbank-id primary="true">DB1</drugbank-id><drugbank-id>X</drugbank-id><name>One</name>
      <experimental-properties><property><kind>Molecular Formula</kind><value>H2</value></property></experimental-properties>
      <pathways><pathway><drugs><drug><drugbank-id>DB9</drugbank-id></drug></drugs></pathway></pathways>
      <targets><target><id>T1</id><name>t</name><actions><action>a</action><action>b</action></actions></target></targets></drug>
    <drug><drugbank-id>none</drugbank-id><name>Two</name></drug></drugbank>"""
    raw = documents.read_xml_records(spark, put(tmp_path / "d.xml", text), "drug", drug_records.DRUG)
    got = drug_records.drugs(raw).collect()
    assert [(r.drugbank_id, r.type, r.formula, r.smiles) for r in got] == [("DB1", "biotech", "H2", "")]
    assert rows(drug_records.targets(raw), "target_id", "actions", "uniprot_id") == [("T1", "a|b", "")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, None, ["a", "b"], 'q"u,o\\te')], "id int, n string, l array<string>, t string")
    columns = ["id", "n", "l", "t", "extra"]
    for fmt in ("csv", "tsv"):
        sinks.write_dataset(df, str(tmp_path / fmt), fmt, columns, {"l": " | "})
        assert rows(sinks.read_written(spark, str(tmp_path / fmt), columns, fmt)) == [("1", "", "a | b", 'q"u,o\\te', "")]
    flat = sinks.json_to_flat(df.withColumn("s", F.struct("id")))
    assert flat.columns == ["id", "l", "n", "s", "t"] and rows(flat, "l", "s") == [("a;b", '{"id":1}')]


def test_zip_archive_without_members(spark, tmp_path):
    # A task without rows writes such an archive.
    for name, members in (("a", {}), ("b", {"x.txt": "one\ntwo"})):
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w") as z:
            for member, data in members.items():
                z.writestr(member, data)
    assert rows(archives.read_zip_members(spark, f"{tmp_path}/*.zip", ".txt"), "member", "pos", "line") == [("x.txt", 0, "one"), ("x.txt", 1, "two")]


def test_flat_xml_by_splits(spark, tmp_path):
    text = "<?xml version='1.0'?><all>\n" + "".join(f"<Row>\n <a> x{i} &amp; </a><Rower>y</Rower><n>{'z' * (i % 7)}</n>\n</Row>\n" for i in range(3_000)) + "<Row/><Row k='1'><a>last</a></Row></all>"
    path, schema = put(tmp_path / "r.xml", text), "a string, Rower string, n string, _k string"
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = documents.read_xml_records(spark, path, "Row", schema, flat=True)
        assert rows(got) == rows(documents.read_xml_records(spark, path, "Row", schema)) and got.count() == 3_002
        plan = spark.read.option("lineSep", "</Row>").text(path)
        assert plan.rdd.getNumPartitions() > 5
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
