"""Dataset jobs on edge records written by hand."""

import json

from conftest import rows
from pyspark.sql import functions as F

from refloom.plans import (
    adverse_events, applications, articles, classes, concepts, descriptors, labels, medicines, patents, substances, trials, works,
)
from refloom.schemas import APPLICATION, ARTICLE, MOLECULE, SAFETY_REPORT, SUBSTANCE, WORK
from refloom.sources.documents import parse_xml


def records(spark, schema, *docs):
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "doc string")
    return df.select(F.from_json("doc", schema).alias("r")).select("r.*")


def test_safety_reports(spark):
    raw = records(
        spark, SAFETY_REPORT,
        {"safetyreportid": 7, "serious": " 1 ", "primarysource": None},
        {"safetyreportid": "8", "companynumb": "ACME-1", "patient": {
            "patientsex": 2, "patientdeath": {"patientdeathdate": "2020"},
            "drug": [{"medicinalproduct": " ASPIRIN ", "openfda": {"brand_name": ["A", "", "B"], "generic_name": "G"}}, {}],
            "reaction": [{"reactionmeddrapt": "Pain"}, {"reactionmeddrapt": " "}, {}]}},
    )
    found = adverse_events.tables(raw)
    assert rows(found["reports"], "safetyreportid", "serious", "patient_sex", "patient_death_date") == [("7", "1", "", ""), ("8", "", "2", "2020")]
    assert rows(found["drugs"], "medicinalproduct", "openfda_brand_name", "openfda_generic_name") == [("", "", ""), ("ASPIRIN", "A | B", "G")]
    assert rows(found["reactions"]) == [("8", "Pain")]
    for term, ids in (("acme", ["8"]), ("aspir", ["8"]), ("PAIN", ["8"]), ("7", ["7"]), ("nothing", [])):
        assert [r.safetyreportid for r in adverse_events.search(found, term).collect()] == ids


def test_applications(spark):
    raw = records(
        spark, APPLICATION,
        {"application_number": "NDA1", "sponsor_name": "S", "openfda": {"rxcui": ["1", "2"], "unii": "U"},
         "submissions": [{"submission_type": "ORIG", "submission_number": 1, "submission_status": "AP", "submission_status_date": "20200102",
                          "application_docs": [{"type": "Label", "url": "u", "date": "202001"}, {"type": "x", "url": ""}]}, {"submission_type": "SUPPL"}],
         "products": [{"product_number": "001", "brand_name": "B", "active_ingredients": [{"name": "I", "strength": "5MG"}, {"name": "J"}]}, {"product_number": "002"}]},
        {"application_number": "NDA2"},
    )
    got = applications.flatten(raw)
    assert len(got.columns) == 25
    flat = rows(got, "application_number", "product_number", "active_ingredients", "openfda_rxcuis", "openfda_uniis", "submissions", "application_docs")
    sub = "ORIG(1) - AP (2020-01-02) | SUPPL() -  ()"
    assert flat == [
        ("NDA1", "001", "I (5MG) | J", "1 | 2", "U", sub, "Label (202001): u"), ("NDA1", "002", "", "1 | 2", "U", sub, "Label (202001): u"),
        ("NDA2", "", "", "", "", "", ""),
    ]
    assert [r.application_number for r in applications.search(raw, "j").collect()] == ["NDA1"]


def test_works(spark):
    inst = {"id": "I1", "display_name": "Inst", "country_code": "FR"}
    raw = records(
        spark, WORK,
        {"id": "W1", "authorships": [
            {"author_position": "first", "author": {"id": "A1", "display_name": "Ann"}, "institutions": [{"id": "I0", "display_name": ""}, inst]},
            {"author": {"display_name": "Bob"}, "institutions": [inst]}, {"author": {"id": "A1", "display_name": "Ann again"}, "institutions": []}],
         "mesh": [{"descriptor_name": "D", "qualifier_name": "q", "is_major_topic": True}, {"descriptor_name": "D", "qualifier_name": "q"}, {"descriptor_name": "E"}],
         "primary_location": {"source": {"id": "S1", "display_name": "J", "issn_l": "1-1"}}, "abstract_inverted_index": {"b": [1], "a": [0]}},
        {"id": "W2"},
    )
    got = {r.work_id: r for r in works.flat(raw).collect()}
    w = got["W1"]
    assert (w.authors, w.first_author_institution, w.institutions, w.countries) == ("Ann; Bob; Ann again", "Inst", "Inst", "FR")
    assert (w.mesh_terms, w.major_mesh_terms, w.issn, w.abstract) == ("D/q; E", "D/q", "1-1", "a b")
    assert (got["W2"].authors, got["W2"].abstract, got["W2"].is_oa) == ("", "", False)
    rel = works.relations(raw)
    assert rows(rel["authors"], "author_id", "display_name") == [("A1", "Ann")]
    assert rows(rel["institutions"], "institution_id") == [("I0",), ("I1",)]
    assert rows(rel["sources"], "source_id") == [("S1",)]
    assert rows(rel["affiliations"]) == [("W1", "A1", "I0", "first"), ("W1", "A1", "I1", "first")]


def test_articles(spark):
    raw = records(
        spark, ARTICLE,
        {"id": "1", "authorString": "All", "pubTypeList": {"pubType": "review"}, "pmcid": "P", "inPMC": "Y"},
        {"id": "2", "authorList": {"author": [{"fullName": "A", "authorId": {"type": "ORCID", "value": "0"}}, {"lastName": "B"}]},
         "pubTypeList": {"pubType": ["x", {"pubType": "y"}]}, "grantsList": {"grant": [{"grantId": "9", "acronym": "Z"}, {"agency": "W", "acronym": "Q"}]},
         "chemicalList": {"chemical": [{"name": "c", "registryNumber": "0"}, {"name": "d", "registryNumber": "1-1"}]},
         "meshHeadingList": {"meshHeading": [{"descriptorName": "H", "majorTopic_YN": "Y"}, {"descriptorName": "I", "majorTopic_YN": "N"}]}},
        {"title": "no id"},
    )
    got = {r.id: r for r in articles.metadata(raw, extended=True).collect()}
    assert set(got) == {"1", "2"} and len(articles.metadata(raw).columns) == 22
    assert (got["1"].authors, got["1"].pub_type) == ("All", "review")
    r = got["2"]
    assert (r.authors, r.author_orcids, r.pub_type) == ("A; B", "0", "x; y")
    assert (r.grants, r.chemicals, r.chemical_registry_numbers) == ("Unknown Agency (ID: 9, Acronym: Z); W", "c; d", "d (1-1)")
    assert (r.mesh_descriptors, r.mesh_major_topics) == ("H; I", "H")
    done = spark.createDataFrame([("x",)], "id string")
    assert rows(articles.extraction_queue(raw, done)) == [("1",)]


def test_dossier(spark):
    ddl = "medicine_name string, ema_product_number string, document_url string, document_type string, extraction_status string, nct_numbers string, clinical_trials_json string, " + ", ".join(f"{c} string" for c in medicines.DOSSIER_TEXT_COLUMNS)
    empty = [None] * (len(medicines.DOSSIER_TEXT_COLUMNS) - 1)
    trial = json.dumps
    data = [
        ("M", "1", "u1", "d", "completed", "N2, N1", trial([{"nct_id": "N1", "brief_title": "T1"}, {"nct_id": "N1", "brief_title": "T2"}]), "", *empty),
        ("M", "1", "u2", "d", "completed", "N1,,", trial([{"nct_id": "N3", "brief_title": "T2"}, {"nct_id": "", "brief_title": "T1"}]), "made", *empty),
        ("M", "1", "u3", "d", "completed", None, "[broken", "later", *empty),
        ("M", "1", "u4", "d", "failed", "N9", None, "x", *empty),
        ("K", "2", "u5", "d", "completed", "", '{"not": "a list"}', None, *empty),
        (None, "3", "u6", "d", "completed", "N8", None, "z", *empty),
    ]
    master = spark.createDataFrame([("1", "sub")], "ema_product_number string, active_substance string")
    master = master.select("*", *[F.lit(None).cast("string").alias(c) for c in medicines.DOSSIER_MASTER_COLUMNS[1:]])
    base = medicines.extraction_base(spark.createDataFrame(data, ddl), master)
    got = rows(medicines.dossier(base), "medicine_name", "active_substance", "composition", "nct_numbers", "nct_id", "brief_title")
    # The second trial falls to the first one, so its title does not block the third.
    assert got == sorted([("K", None, None, "", None, None), ("M", "sub", "made", "N1,N2", "N1", "T1"), ("M", "sub", "made", "N1,N2", "N3", "T2")], key=repr)


def test_patents(spark):
    ddl = "Appl_Type string, Appl_No string, Product_No string, "
    products = spark.createDataFrame([("N", "1", "001", "A"), ("N", "2", "001", "B")], ddl + "Trade_Name string")
    codes = spark.createDataFrame([("U-1", "use one")], "code string, definition string")
    listed = spark.createDataFrame([("N", "1", "001", "P1", "Jan 1, 2030", "U-1"), ("N", "1", "001", "P2", "", ""), ("N", "1", "001", "P3", "x", "U-9")],
                                   ddl + "Patent_No string, Patent_Expire_Date_Text string, Patent_Use_Code string")
    excl = spark.createDataFrame([("N", "1", "001", "NCE", "2031")], ddl + "Exclusivity_Code string, Exclusivity_Date string")
    got = {r.Appl_No: r for r in patents.unify(
        products, patents.with_definitions(listed, codes, "Patent_Use_Code", "Patent_Use_Definition"),
        patents.with_definitions(excl, codes, "Exclusivity_Code", "Exclusivity_Definition")).collect()}
    assert got["1"].Active_Patents_List == "Patent P1 (Exp: Jan 1, 2030) [Use: U-1 - use one] | Patent P2 (Exp: ) | Patent P3 (Exp: x) [Use: U-9 - ]"
    assert (got["1"].Active_Patents_Count, got["1"].Active_Exclusivities_List) == (3, "Exclusivity NCE (Exp: 2031)")
    assert (got["2"].Active_Patents_Count, got["2"].Active_Patents_List) == (0, "")


def test_biologics(spark):
    products = spark.createDataFrame(
        [(1, "0012", "Brand", "351(a)", None), (2, "013", "brand ", "351(a)", ""), (3, "20", "N/A", "351(k)", " BRAND"), (4, "21", "Other", "351(k)", "N/A"), (5, None, "", "351(a)", None)],
        "at int, `BLA Number` string, `Proprietary_Name` string, `License Type` string, `Ref. Product Proprietary Name` string",
    )
    listed = spark.createDataFrame([("013", "P1", "2030"), ("0012", "P0", "2029"), ("13", "P2", None)], "`Reference Product BLA Number` string, `Patent Number` string, `Patent Expiration Date` string")
    got = {r.bla_number: r for r in patents.biologics(products, listed, "at").collect()}
    assert got["20"].resolved_reference_bla == "13" and got["20"].patent_numbers == "P1; P2" and got["20"].patent_expirations == "2030; "
    assert got["0012"].patent_numbers == "P0" and got["0012"].resolved_reference_bla == "N/A"
    assert got["21"].associated_patents_count == 0 and got[""].proprietary_name == "N/A"
    assert len(got["20"].asDict()) == 28


def test_headings(spark):
    xml = """<DescriptorRecord><DescriptorUI>D1</DescriptorUI><DescriptorName><String>Asthma</String></DescriptorName>
      <ConceptList><Concept PreferredConceptYN="N"><ScopeNote>no</ScopeNote><TermList><Term><String>ASTHMA</String></Term><Term><String>Wheeze</String></Term></TermList></Concept>
      <Concept PreferredConceptYN="Y"><ScopeNote> note </ScopeNote><RegistryNumberList><RegistryNumber>R1</RegistryNumber><RegistryNumber>R2</RegistryNumber></RegistryNumberList></Concept></ConceptList>
      <TreeNumberList><TreeNumber>C1</TreeNumber><TreeNumber>C2</TreeNumber></TreeNumberList></DescriptorRecord>"""
    df = spark.createDataFrame([(xml,), ("<DescriptorRecord><DescriptorUI>D2</DescriptorUI></DescriptorRecord>",)], "x string")
    raw = df.select(parse_xml("x", descriptors.DESCRIPTOR).alias("r")).select("r.*")
    assert rows(descriptors.descriptors(raw)) == [("D1", "Asthma", "note", "C1;C2", "R1", "Wheeze", "")]


def test_trial_documents(spark):
    xml = """\ufeff<trial><main><trial_id> T1 </trial_id></main><contacts><contact><type>Public</type><lastname>A</lastname></contact>
      <contact><type>public</type><lastname>B</lastname></contact><contact><type>Scientific/Public</type><lastname>C</lastname></contact></contacts>
      <countries><country2>X</country2><country2> Y</country2></countries></trial>"""
    raw = spark.createDataFrame([(xml,)], "x string").select(parse_xml("x", trials.NATIONAL_TRIAL).alias("r")).select("r.*")
    got = trials.national(raw)
    assert len(got.columns) == 72
    r = got.head()
    assert (r.trial_id, r.public_contact_lastname, r.scientific_contact_lastname, r.countries, r.phase) == ("T1", "B", "C", "X | Y", "")


def test_substances(spark):
    raw = records(spark, SUBSTANCE, {"uuid": "u", "_name": "Aspirin", "codes": [{"codeSystem": "CAS", "code": "1"}, {"codeSystem": "X", "code": "9"}, {"codeSystem": "CAS", "code": "1"}],
                                     "names": [{"name": "ASPIRIN"}, {"name": "z"}, {"name": " a "}, {"name": "z"}]}, {"uuid": "v", "deprecated": True})
    assert rows(substances.registrations(raw), "uuid", "cas_number", "synonyms", "deprecated") == [("u", "1", "z|a", False), ("v", "", "", True)]
    raw = records(spark, MOLECULE, {"chembl_id": "C", "molecule_properties": None, "molecule_synonyms": [{"molecule_synonym": "b"}, {"molecule_synonym": "a"}, {"molecule_synonym": "b"}]})
    assert rows(substances.molecules(raw), "chembl_id", "alogp", "synonyms") == [("C", None, "a|b")]


def test_concepts(spark):
    raw = records(
        spark, concepts.CONCEPT,
        {"rxcui": "1", "name": "in", "tty": "IN", "related": [{"tty": "BN", "conceptProperties": [{"name": "B"}, {"name": "A"}, {"name": "B"}]}]},
        {"rxcui": "2", "name": "two", "tty": "MIN", "related": [{"tty": "IN", "conceptProperties": [{"rxcui": "8", "name": "x"}, {"rxcui": "9", "name": "y"}]}, {"tty": "IN"}]},
        {"rxcui": "3", "name": "none", "tty": "MIN"},
    )
    assert rows(concepts.ingredients(raw), "rxcui", "synonym", "ingredient_rxcui", "ingredient_name") == [
        ("1", "B|A", "1", "in"), ("2", "", "8", "x"), ("2", "", "9", "y"), ("3", "", "", ""),
    ]


def test_class_tree(spark):
    seen = spark.createDataFrame([("A", "Top", "", 1), ("A01", "", "short", 2), ("A01", "Mid", "longer text", 3), ("A01", "Late", "equal  text", 4), ("B01A", "Orphan", "", 5)],
                                 "code string, name string, description string, at int")
    known = classes.classes(seen, "at")
    assert rows(known, "code", "name", "description") == [("A", "Top", ""), ("A01", "Mid", "longer text"), ("B01A", "Orphan", "")]
    leaves = spark.createDataFrame([("A01AA01", "leaf", "", "", "", "", "A01AA")], "code string, name string, ddd string, unit string, adm_route string, note string, parent_code string")
    tree = {r.code: json.loads(r.node) for r in classes.tree(known, leaves).collect()}
    assert set(tree) == {"A", "B01A", "A01AA01"} and [c["code"] for c in tree["A"]["children"]] == ["A01"]
    assert "children" not in tree["A01AA01"] and tree["A"]["children"][0]["children"] == []


def test_labels(spark):
    metadata = spark.createDataFrame([("s1", "B title", 1), ("s2", "A title", 1)], "setid string, title string, spl_version int")
    concept = spark.createDataFrame([("s1", 1, "11", "aspirin"), ("s1", 1, "12", "zinc")], "setid string, spl_version int, rxcui string, rxstring string")
    linked = spark.createDataFrame([("s2", 1, "p1"), ("s9", 1, "p2")], "spl_setid string, spl_version int, pharma_setid string")
    assert [(r.setid, r.rxcui) for r in labels.with_concepts(metadata, concept).collect()] == [("s2", None), ("s1", "11"), ("s1", "12")]
    assert rows(labels.with_classes(linked, metadata), "setid", "title") == [("s2", "A title"), ("s9", None)]
    assert [r.setid for r in labels.search(metadata, concept, "ZIN").collect()] == ["s1"]
    assert rows(labels.statistics(metadata, concept, linked), "table", "n_rows", "n_setid") == [("classes", 2, 2), ("concepts", 2, 1), ("metadata", 2, 2)]
