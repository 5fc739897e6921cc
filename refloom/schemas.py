"""Declared layouts of the source extracts. Fixed values, in the order the files have them."""

from __future__ import annotations

from pyspark.sql import types as T


def text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Column order of the header-less drug product extract, by file key.
DRUG_PRODUCT_FILES = {
    "drug": [
        "drug_code", "web_referral_flag", "product_categorization", "drug_identification_number",
        "brand_name", "descriptor", "pediatric_flag", "access_dementia_flag", "therapeutic_class_flag",
        "last_update_date", "expiry_date", "product_categorization_fr", "descriptor_fr",
        "external_status_code",
    ],
    "ingred": [
        "drug_code", "active_ingredient_code", "ingredient_name", "ingredient_flag", "strength",
        "strength_unit", "strength_type", "dosage_value", "dosage_unit", "rare_ingredient_flag",
        "historic_freeform", "ingredient_name_fr", "strength_unit_fr", "dosage_unit_fr", "extra_flag",
    ],
    "comp": [
        "drug_code", "mfr_code", "company_code", "company_name", "company_type", "address_mailing_flag",
        "address_billing_flag", "address_notification_flag", "address_other_flag", "suite_number",
        "street_name", "city_name", "province_name", "country_name", "postal_code", "post_office_box",
        "province_name_fr", "country_name_fr",
    ],
    "route": [
        "drug_code", "route_of_administration_code", "route_of_administration_en",
        "route_of_administration_fr",
    ],
    "form": [
        "drug_code", "pharmaceutical_form_code", "pharmaceutical_form_en", "pharmaceutical_form_fr",
    ],
    "status": [
        "drug_code", "current_status_flag", "status_en", "history_date", "status_fr", "extra_field_1",
        "extra_field_2",
    ],
    "ther": ["drug_code", "tc_atc_number", "tc_atc", "tc_ahfs_number"],
    "schedule": ["drug_code", "schedule_en", "schedule_fr"],
    "package": [
        "drug_code", "upc", "package_size_unit_en", "package_size", "product_information_en",
        "package_type_en", "package_size_unit_fr", "product_information_fr",
    ],
    "vet": ["drug_code", "veterinary_species_en", "veterinary_species_fr", "extra_vet_field"],
    "pharm": ["drug_code", "pharmaceutical_std"],
    "biosimilar": ["drug_code", "biosimilar_flag_en", "biosimilar_flag_fr", "biosimilar_type_code"],
}

# Output columns of the three safety report tables.
REPORT_COLUMNS = [
    "safetyreportid", "transmissiondate", "serious", "seriousnessdeath", "seriousnesslifethreatening",
    "seriousnesshospitalization", "seriousnessdisabling", "seriousnesscongenitalanomoly",
    "seriousnessother", "receivedate", "receiptdate", "reportercountry", "companynumb",
    "senderorganization", "patient_age", "patient_age_unit", "patient_sex", "patient_death_date",
]
REPORT_DRUG_COLUMNS = [
    "safetyreportid", "drugcharacterization", "medicinalproduct", "drugdosagetext",
    "drugadministrationroute", "drugindication", "openfda_brand_name", "openfda_generic_name",
    "openfda_manufacturer_name", "openfda_substance_name", "openfda_pharm_class_pe",
]
REACTION_COLUMNS = ["safetyreportid", "reactionmeddrapt"]

# A list may also come as one plain text, so these are read as text and unpacked by ``text_list``.
_LISTS = ", ".join(
    f"{n}: string"
    for n in (
        "brand_name", "generic_name", "manufacturer_name", "product_ndc", "package_ndc", "rxcui",
        "unii", "substance_name", "spl_set_id", "product_type", "pharm_class_epc", "pharm_class_moa",
        "pharm_class_pe",
    )
)

SAFETY_REPORT = f"""
    safetyreportid string, transmissiondate string, serious string, seriousnessdeath string,
    seriousnesslifethreatening string, seriousnesshospitalization string, seriousnessdisabling string,
    seriousnesscongenitalanomoly string, seriousnessother string, receivedate string,
    receiptdate string, companynumb string,
    primarysource struct<reportercountry: string>,
    sender struct<senderorganization: string>,
    patient struct<
        patientonsetage: string, patientonsetageunit: string, patientsex: string,
        patientdeath: struct<patientdeathdate: string>,
        drug: array<struct<
            drugcharacterization: string, medicinalproduct: string, drugdosagetext: string,
            drugadministrationroute: string, drugindication: string, openfda: struct<{_LISTS}>>>,
        reaction: array<struct<reactionmeddrapt: string>>>
"""

# Packed list columns of an application row, by source list.
APPLICATION_LISTS = {
    "openfda_brand_names": "brand_name",
    "openfda_generic_names": "generic_name",
    "openfda_manufacturers": "manufacturer_name",
    "openfda_product_ndcs": "product_ndc",
    "openfda_package_ndcs": "package_ndc",
    "openfda_rxcuis": "rxcui",
    "openfda_uniis": "unii",
    "openfda_substance_names": "substance_name",
    "openfda_spl_set_ids": "spl_set_id",
    "openfda_product_types": "product_type",
    "openfda_pharm_class_epc": "pharm_class_epc",
    "openfda_pharm_class_moa": "pharm_class_moa",
    "openfda_pharm_class_pe": "pharm_class_pe",
}
APPLICATION_PRODUCT = [
    "product_number", "brand_name", "reference_drug", "reference_standard", "dosage_form", "route",
    "marketing_status",
]

APPLICATION = f"""
    application_number string, sponsor_name string,
    submissions array<struct<
        submission_type: string, submission_number: string, submission_status: string,
        submission_status_date: string,
        application_docs: array<struct<type: string, url: string, date: string>>>>,
    openfda struct<{_LISTS}>,
    products array<struct<
        product_number: string, brand_name: string, reference_drug: string, reference_standard: string,
        dosage_form: string, route: string, marketing_status: string,
        active_ingredients: array<struct<name: string, strength: string>>>>
"""

WORK = """
    id string, doi string, title string, publication_year int, publication_date string, type string,
    language string, cited_by_count bigint, updated_date string,
    primary_location struct<source: struct<
        id: string, display_name: string, host_organization_name: string, issn_l: string,
        issn: array<string>>>,
    open_access struct<is_oa: boolean, oa_status: string, oa_url: string>,
    authorships array<struct<
        author_position: string, author: struct<id: string, display_name: string, orcid: string>,
        institutions: array<struct<
            id: string, display_name: string, ror: string, country_code: string, type: string>>>>,
    primary_topic struct<
        display_name: string, field: struct<display_name: string>, domain: struct<display_name: string>>,
    mesh array<struct<descriptor_name: string, qualifier_name: string, is_major_topic: boolean>>,
    funders array<struct<display_name: string>>,
    abstract_inverted_index map<string, array<int>>
"""

ARTICLE = """
    id string, source string, pmid string, pmcid string, doi string, title string,
    abstractText string, authorString string, journalTitle string, pubYear string,
    isOpenAccess string, inEPMC string, inPMC string, hasPDF string, citedByCount bigint,
    dateOfCreation string, firstPublicationDate string,
    authorList struct<author: array<struct<
        fullName: string, lastName: string, authorId: struct<type: string, value: string>,
        authorAffiliationDetailsList: struct<
            authorAffiliation: array<struct<affiliation: string>>>>>>,
    journalInfo struct<
        volume: string, issue: string, journal: struct<title: string, issn: string>>,
    meshHeadingList struct<meshHeading: array<struct<descriptorName: string, majorTopic_YN: string>>>,
    chemicalList struct<chemical: array<struct<name: string, registryNumber: string>>>,
    grantsList struct<grant: array<struct<agency: string, grantId: string, acronym: string>>>,
    fullTextUrlList struct<fullTextUrl: array<struct<url: string, documentStyle: string, site: string>>>,
    pubTypeList struct<pubType: string>
"""

SUBSTANCE = """
    uuid string, approvalID string, _name string, substanceClass string, status string,
    definitionType string, definitionLevel string, deprecated boolean,
    codes array<struct<codeSystem: string, code: string>>, names array<struct<name: string>>
"""

MOLECULE = """
    molecule_chembl_id string, chembl_id string, pref_name string, molecule_type string,
    max_phase string, similarity string,
    molecule_properties struct<mw_freebase: string, alogp: string, hba: string, hbd: string>,
    molecule_structures struct<canonical_smiles: string, standard_inchi_key: string>,
    molecule_synonyms array<struct<molecule_synonym: string>>
"""
TARGET = """
    target_chembl_id string, pref_name string, target_type string, organism string,
    target_components array<struct<accession: string>>
"""
# Columns of an activity row.
ACTIVITY_COLUMNS = [
    "activity_id", "molecule_chembl_id", "target_chembl_id", "assay_chembl_id", "type", "relation",
    "value", "units", "canonical_data_validity_comment", "document_chembl_id", "uo_units",
    "standard_type", "standard_relation", "standard_value", "standard_units",
]

# The trial list columns of a medicine dossier.
DOSSIER_TRIAL_COLUMNS = [
    "nct_id", "brief_title", "official_title", "overall_status", "start_date", "sponsor", "condition",
    "phase", "intervention_name", "intervention_type", "primary_outcome", "secondary_outcome",
    "country", "study_type", "enrollment",
]
DOSSIER_TRIALS = "array<struct<" + ", ".join(f"{c}: string" for c in DOSSIER_TRIAL_COLUMNS) + ">>"
DOSSIER_MASTER_COLUMNS = [
    "active_substance", "therapeutic_area_mesh", "atc_code_human",
    "marketing_authorisation_developer_applicant_holder", "marketing_authorisation_date",
]
DOSSIER_TEXT_COLUMNS = [
    "composition", "therapeutic_indications", "posology", "contraindications", "undesirable_effects",
    "benefits_in_studies", "benefit_risk_balance", "document_summary", "document_procedure_dates",
]

# Fields of a trial in the multi-country registry export.
REGISTRY_TRIAL_COLUMNS = [
    "TrialID", "Last_Refreshed_on", "Public_title", "Scientific_title", "Acronym",
    "Primary_sponsor", "Secondary_Sponsor", "Source_Register", "web_address",
    "Prospective_registration", "Date_registration", "Date_registration3",
    "Recruitment_Status", "other_records", "Inclusion_agemin", "Inclusion_agemax",
    "Inclusion_gender", "Date_enrollement", "Target_size", "Study_type",
    "Study_design", "Phase", "Countries", "Contact_Firstname", "Contact_Lastname",
    "Contact_Address", "Contact_Email", "Contact_Tel", "Contact_Affiliation",
    "Inclusion_Criteria", "Exclusion_Criteria", "Condition", "Intervention",
    "Primary_outcome", "Secondary_outcome", "Secondary_ID", "Source_Support",
    "Ethics_review_status", "Ethics_review_approval_date", "Ethics_review_contact_name",
    "Ethics_review_contact_address", "Ethics_review_contact_phone", "Ethics_review_contact_email",
    "results_date_posted", "results_url_link", "results_url_protocol", "results_date_completed",
    "results_date_first_publication", "results_summary", "results_baseline_char",
    "results_adverse_events", "results_outcome_measures", "results_ipd_plan",
    "results_ipd_description", "results_yes_no", "Export_date", "Internal_Number",
]

# The main block and contact fields of a national trial document.
TRIAL_MAIN_FIELDS = [
    "trial_id", "utrn", "reg_name", "date_registration", "primary_sponsor", "public_title", "acronym",
    "scientific_title", "scientific_acronym", "date_enrolment", "type_enrolment", "target_size",
    "recruitment_status", "url", "study_type", "study_design", "phase", "hc_freetext", "i_freetext",
    "results_actual_enrolment", "results_date_completed", "results_url_link", "results_summary",
    "results_date_posted", "results_date_first_publication", "results_baseline_char",
    "results_participant_flow", "results_adverse_events", "results_outcome_measures",
    "results_url_protocol", "results_IPD_plan", "results_IPD_description",
]
TRIAL_CONTACT_FIELDS = [
    "firstname", "middlename", "lastname", "address", "city", "country1", "zip", "telephone", "email",
    "affiliation",
]
TRIAL_CRITERIA_FIELDS = ["inclusion_criteria", "exclusion_criteria", "agemin", "agemax", "gender"]
TRIAL_ETHICS_FIELDS = [
    "status", "approval_date", "contact_name", "contact_address", "contact_phone", "contact_email",
]

# Columns of a tab separated terminology release.
TERMINOLOGY_COLUMNS = [
    "Code", "Codelist Code", "Codelist Extensible (Yes/No)", "Codelist Name",
    "CDISC Submission Value", "CDISC Synonym(s)", "CDISC Definition", "NCI Preferred Term",
]
# Columns of a flat concept file.
CONCEPT_COLUMNS = [
    "code", "concept_iri", "parents", "synonyms", "definition", "display_name", "concept_status",
    "semantic_types", "concept_in_subsets",
]
