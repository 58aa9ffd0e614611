"""Share of planted paraphrases that the cosines of the benchmark search find by themselves."""
import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

pytest.importorskip("public_tokenizers")

from losslens.llm import decontaminate  # noqa: E402


@pytest.mark.parametrize("changed", [0.0, 0.1, 0.15])
def test_cosines_find_paraphrases(spark, changed):
    rnd = random.Random(int(changed * 100))
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 8))) for _ in range(4000)]
    say = lambda n: [rnd.choice(words) for _ in range(n)]
    items, rows = [say(rnd.randint(15, 58)) for _ in range(60)], []
    for d in range(600):
        leak = list(items[d % 60])
        for k in rnd.sample(range(len(leak) - 5), int(changed * len(leak))):
            leak[k] = rnd.choice(words)
        body = say(rnd.randint(30, 300))
        at = rnd.randint(0, len(body))
        rows.append((d, " ".join(body[:at] + leak + body[at:])))
    found = decontaminate.contaminated(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(6),
        spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")).collect()
    pairs = {(r.doc_id, r.item_id): r.by_cosine for r in found}
    assert all((d, d % 60) in pairs for d in range(600))  # cosines and rarest words together miss none
    assert sum(pairs[d, d % 60] for d in range(600)) >= 0.9 * 600
