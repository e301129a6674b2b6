from strandline.llm import licenses


def test_short_and_other_creative_commons_forms(spark):
    kinds = ["BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"]
    rows = [(k, f"some words before\nLicensed under CC {kind} 4.0.\nand after") for k, kind in enumerate(kinds)]
    rows.append((9, "Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/\n\nTERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION\n1. Definitions."))
    got = {(r.doc_id, r.license) for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(k, f"CC-{kind}-4.0") for k, kind in enumerate(kinds)} | {(9, "Apache-2.0")}
