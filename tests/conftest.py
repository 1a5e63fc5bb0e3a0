import os
import random

import pytest

from claimforge.session import session
from claimforge.vocab import ACTIONS, OBJECTS, RELATIONS

os.environ.setdefault("CLAIMFORGE_DRIVER_MEMORY", "6g")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session("tests", cores=4)
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    return s


def frame(number, secs, vertices, split="train"):
    return f"f_{number:03}", {"type": "frame", "id": f"f_{number:03}", "secs": secs, "metadata": split, "vertices": vertices}


def vertex(number, cls, box=(0.1, 0.1, 0.5, 0.5), **relations):
    v = {"id": f"{cls}/{number}", "class": cls, "visible": True, "bbox": None if box is None else list(box)}
    return v | {kind: [{"id": f"{r}/{number}", "class": r, "objects": [{"class": cls}]} for r in rs] for kind, rs in relations.items()}


def action(number, phrase, start, end):
    return f"act_{number}", {"type": "action", "id": f"act_{number}", "charades": "c000", "phrase": phrase, "start": float(start), "end": float(end), "all_f": []}


def fixture_video():
    """Three frames of chair, window and food with four relations, and two actions."""
    vertices = [vertex(1, "o8", contact=["r21"]), vertex(1, "o36", spatial=["r6"]), vertex(1, "o17", attention=["r1"], contact=["r15"])]
    entries = dict([frame(1, 1.0, vertices), frame(2, 2.5, vertices), frame(3, 5.0, vertices), action(1, "sitting in a chair", 0.5, 3.0), action(2, "watching outside of a window", 3.5, 6.0)])
    return {"video_id": "SYNTH_VID_001", "entries": entries}


def random_videos(n, seed=1):
    r, out = random.Random(seed), []
    for i in range(n):
        classes = r.sample(sorted(OBJECTS), r.randint(2, 6))
        picks = lambda kind, most: r.sample(sorted(RELATIONS[kind]), r.randint(0, most))
        relations = {c: {"attention": picks("attention", 1), "spatial": picks("spatial", 2), "contact": picks("contact", 2)} for c in classes}
        entries = dict(frame(k, float(k), [vertex(k, c, None if r.random() < 0.1 else (0.0, 0.0, 1.0, 1.0), **relations[c]) for c in classes]) for k in range(r.randint(1, 3)))
        entries |= dict(action(k, p, r.randint(0, 30), 31) for k, p in enumerate(r.sample(ACTIONS, r.randint(0, 6))))
        out.append({"video_id": f"V{i:05}", "entries": entries})
    return out


@pytest.fixture(scope="session")
def raw(spark):
    from claimforge.schemas import RAW

    return lambda videos: spark.createDataFrame(videos, RAW)
