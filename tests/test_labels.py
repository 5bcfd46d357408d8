"""Labels beside values by hand-made cases."""

import json

from millrace.operators import labels as L

TEXT = """# Policy
Policy Number: WC-8842317
**Insured** Acme Manufacturing
Effective ......... 04/01/2026
Carrier Name
Great American

| Vehicle | VIN | Premium |
|---|:-:|--:|
| Ford | 1HGCM826 | $1,250.00 |
| Fiat | 9ZZZZ111 | 900.00 |

| Total | 2,150.00 |
"""
DOC = {"policy_number": "WC-8842317", "insured": "Acme Manufacturing", "effective_date": "2026-04-01", "carrier": "Great American", "vehicles": [{"vin": "1HGCM826", "premium": 1250.0}, {"vin": "9ZZZZ111"}], "total_premium": "2150.00", "gone": "Nowhere at all", "no": "abc", "none": None}


def test_layouts():
    found = {p: (o, label, layout) for p, o, label, layout in L.derived(DOC, TEXT)}
    assert found == {
        "policy_number": ("labelled", "Policy Number", "inline_kv"), "insured": ("labelled", "Insured", "bold_adjacent"), "effective_date": ("labelled", "Effective", "dotted_leader"),
        "carrier": ("labelled", "Carrier Name", "stacked_form"), "vehicles[0].vin": ("labelled", "VIN", "table_column_header"), "vehicles[0].premium": ("labelled", "Premium", "table_column_header"),
        "vehicles[1].vin": ("labelled", "VIN", "table_column_header"), "total_premium": ("labelled", "Total", "table_row_label"), "gone": ("not_found", None, None), "no": ("too_short", None, None),
    }
    assert L.clean("**Policy Number**: ....... ") == "Policy Number" and L.clean("| - Total  Premium |") == "Total Premium"
    assert L.label_of("WC-1234", 0) is None and L.places("a b", True, "x") == [] and L.places("x", None, "x") == []
    assert L.places("Paid 04/01/2026, due", "2026-04-01", "due_date") == [5] and L.places("1 Jan 2026", "2026-01-01", "d_date") == [0]


def test_label_frames(spark):
    rows = [(1, json.dumps(DOC), TEXT), (2, json.dumps({"policy_number": "XY-77"}), "Policy Number: XY-77"), (3, None, TEXT), (4, json.dumps(DOC), None)]
    df = spark.createDataFrame(rows, "id int, doc string, page string")
    found = L.derive_labels(df, ["id"], "doc", "page")
    assert found.where("id = 3").count() == 0 and found.where("id = 4 AND outcome = 'labelled'").count() == 0
    entry = {(r.field, r.label): r for r in L.registry(found, "id").collect()}
    assert entry["policy_number", "Policy Number"].documents == 2 and entry["policy_number", "Policy Number"].examples == [1, 2]
    assert entry["vehicles[].vin", "VIN"].documents == 1 and entry["vehicles[].vin", "VIN"].confidence == 0.95
    assert L.registry(found, "id", least=2).count() == 1 and L.derive_labels(df.limit(0), ["id"], "doc", "page").count() == 0
