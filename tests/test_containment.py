"""The containment index against plain recursion."""

import json
import random

import __spark_entry__ as E
from conftest import SF_SMALL

from basketry.operators.containment import contained


def holds(have, want):
    if isinstance(want, dict):
        return isinstance(have, dict) and all(k in have and holds(have[k], v) for k, v in want.items())
    if isinstance(want, list):
        return isinstance(have, list) and all(any(holds(h, w) for h in have) for w in want)
    return type(have) is not bool and type(want) is not bool and have == want if isinstance(want, (int, float)) and not isinstance(want, bool) \
        else type(have) is type(want) and have == want


def made(rng, depth=0, wants=False):
    """Objects of objects, lists of scalars, scalars that look alike."""
    out = {}
    for k in rng.sample(["a", "b", "c.d", "é", "['", "a.b"], rng.randint(0 if wants else 1, 3)):
        kind = rng.randrange(4 if depth < 3 else 2)
        out[k] = (made(rng, depth + 1, wants) if kind == 2 else [rng.choice([1, "1", True, None, 2.5]) for _ in range(rng.randint(0, 3))] if kind == 3
                  else rng.choice([1, 1.0, "1", 2, "x", True, False, None, "true", 1e3, 1000, -0.5]))
    return out


def test_random_documents(spark):
    rng = random.Random(3)
    items = [(i, json.dumps(made(rng))) for i in range(250)] + [(900, None), (901, "no json"), (902, "{}"), (903, "[1]")]
    wants = [(i, json.dumps(made(rng, wants=True))) for i in range(120)]
    wants += [(500 + i, items[i][1]) for i in range(20)] + [(800, "{}"), (801, None), (802, "{"), (803, '{"a": {}}'), (804, '{"a": []}')]
    got = {(r.q, r.i) for r in contained(spark.createDataFrame(wants, "q long, w string"), spark.createDataFrame(items, "i long, t string"),
                                         "q", "w", "i", "t").collect()}
    parse = lambda t: json.loads(t) if t and t not in ("no json", "{") else None
    want = {(q, i) for q, w in wants for i, t in items if parse(w) is not None and parse(t) is not None and holds(parse(t), parse(w))}
    assert got == want and len(want) > 300


def test_the_index_is_joined_by_equal_keys(spark):
    plan = E.queries()["attribute_containment"](spark, SF_SMALL)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
