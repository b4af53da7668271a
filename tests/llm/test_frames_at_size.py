import random

import pandas as pd

from sheafline.llm import batches


def test_a_crowded_frame_is_not_compared_in_full():
    rng = random.Random(1)
    names = ["".join(rng.choice("bdfgklmnprstvz") + rng.choice("aeiou") for _ in range(5)) + "x" for _ in range(2000)]
    names[-1] = names[0][:3] + "q" + names[0][4:-2] + "yx"  # two letters of another name changed
    rows = pd.DataFrame({"block": 1, "seq": range(len(names)), "d0": 0, "d1": 0, "flags": 1, "rest": names})
    met = pd.concat(batches._in_frames(iter([rows[:900], rows[900:]])))
    assert (0, 1999) in set(met.itertuples(index=False, name=None))
    assert len(met) < 0.1 * len(names) * (len(names) - 1) / 2
