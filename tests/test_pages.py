import pytest

from notecode.operators import pages
from notecode.plans.roles import role
from notecode.sources.tables import table

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    named = {"charts": "charts", "sections": "document_sections", "merged": "merged_entities"}
    roles = {"assertions": "assertions", "icd": "icd10_mappings", "loinc": "loinc_mappings", "loinc_codes": "loinc_codes", "metrics": "runs", "patterns": "patterns"}
    codes = role(spark, D, "icd_ref").withColumnRenamed("description", "display_name")
    return pages.Tables(**{k: table(spark, D, v) for k, v in named.items()}, **{k: role(spark, D, v) for k, v in roles.items()}, icd_codes=codes)


PAGES = ["pipeline_overview", "review_queue", "icd10_analytics", "loinc_analytics", "pipeline_extended", "icd10_extended", "loinc_extended", "extraction_layers", "assertions", "recall_metrics", "error_patterns", "coding_tiers"]


@pytest.mark.parametrize("page", PAGES)
def test_page(tables, page):
    shown = getattr(pages, page)(tables)
    assert shown and all(df.limit(1).count() == 1 for name, df in shown.items() if name not in ("disambiguation",))


def test_single_rows(tables):
    wanted = tables.icd.orderBy("mapping_id").head()
    item = pages.review_item(tables, wanted.mapping_id)["item"].collect()
    assert len(item) == 1 and item[0].code == wanted.code and item[0].code_type == "ICD-10"
    assert pages.review_item(tables, "none")["item"].count() == 0
    lineage = pages.chart_lineage(tables, wanted.chart_id)
    assert set(lineage) == {"chart", "sections", "entities", "mappings"} and lineage["mappings"].count() >= 1
    queue = pages.review_queue(tables, status="needs_review", page_size=5)
    assert queue["items"].count() == 5 and {r.status for r in queue["items"].collect()} == {"pending"}


def test_filters_are_checked(tables):
    with pytest.raises(ValueError):
        pages.review_queue(tables, page=0)
