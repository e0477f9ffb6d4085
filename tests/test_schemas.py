import re
from pathlib import Path

from tallyhouse.sources.schemas import SCHEMAS

def test_names_order_and_types_match_the_fixture_table():
    text = (Path(__file__).resolve().parent.parent / "FIXTURES.md").read_text()
    rows = re.findall(r"^\| `(\w+)` \| \d+ \| `[^`]+` \| (.*) \|$", text, re.M)
    assert {table for table, _ in rows} == set(SCHEMAS)
    for table, body in rows:
        assert all(field.nullable for field in SCHEMAS[table])
        wanted = []
        for part in body.split(";"):
            names, kind = part.rsplit(":", 1)
            wanted += [(name, kind.strip()) for name in names.split()]
        assert [(f.name, f.dataType.simpleString()) for f in SCHEMAS[table]] == wanted, table
