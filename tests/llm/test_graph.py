"""Connected components against a plain search."""

import random

from formspark.llm._graph import components


def test_chains_stars_and_islands(llm):
    r = random.Random(4)
    ids = r.sample(range(10_000), 300)
    links = [(ids[i], ids[i + 1]) for i in range(120)]  # a long chain in random order
    links += [(ids[130], ids[i]) for i in range(131, 180)] + [(ids[200], ids[201]), (ids[201], ids[200]), (ids[202], ids[202])]
    links += [(ids[r.randrange(210, 300)], ids[r.randrange(210, 300)]) for _ in range(60)]
    near = {}
    for a, b in links:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want, todo = {}, set(near)
    while todo:
        seen, stack = set(), [todo.pop()]
        while stack:
            x = stack.pop()
            if x not in seen:
                seen.add(x)
                stack += near[x]
        want |= dict.fromkeys(seen, min(seen))
        todo -= seen
    got = components(llm.createDataFrame(links, "a long, b long"))
    assert {x.node: x.component for x in got.collect()} == want
    assert components(llm.createDataFrame([], "a long, b long")).count() == 0
