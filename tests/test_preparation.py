"""Invariants of the whole preparation on generated stays; the query prepare_study compares it with SQL."""

import random
from dataclasses import replace

import pytest

from tests.helpers import at, frame
from wardline import Settings
from wardline.functions.codes import FEATURES, LAB_RULES, VITAL_RULES, labels_of
from wardline.plans.preparation import prepare
from wardline.sources import schemas

LABS, VITALS = labels_of(LAB_RULES), labels_of(VITAL_RULES)


@pytest.fixture(scope="module")
def study(spark):
    draw = random.Random(11)
    stages, labs, vitals, flags, detail = [], [], [], [], []
    for stay in range(1, 41):
        hours = draw.choice([20, 60, 90, 150])
        detail.append((stay, stay, stay, float(draw.choice([10, 30, 70])), draw.choice("FM"), draw.choice(["asian", "white"]), "URGENT"))
        onset = draw.uniform(0, hours * 1.5)
        for t in sorted(draw.uniform(0, hours) for _ in range(hours // 3)):
            moment = at(t + draw.random())
            stages.append((stay, moment, draw.uniform(0.5, 3), draw.uniform(0, 2), None, draw.uniform(0, 2), 0, 0, 2 if t > onset else 0))
            labs.append((stay, stay, stay, moment, *[x for n in LABS for x in [draw.uniform(1, 9)] * 2]))
            vitals.append((stay, stay, stay, moment, *[draw.uniform(40, 90) for _ in VITALS for _ in range(3)]))
            flags.append((stay, moment, draw.randint(0, 1), 0, draw.randint(0, 1)))
        stages += [(stay, at(h), 1.0, 1.0, 1.0, 1.0, 0, 0, None) for h in (0, hours)]
    make = lambda schema, data: spark.createDataFrame(data, schema)
    return {
        "stages": make(schemas.STAGES, stages),
        "labs": make(schemas.LABS, labs),
        "vitals": make(schemas.VITALS, vitals),
        "flags": make(schemas.FLAGS, flags),
        "detail": make(schemas.DETAIL, detail),
    }


def test_first_onset_rows(study):
    made = prepare(study)
    assert made.features == [n for n, _ in FEATURES]
    rows = made.rows.collect()
    ages = {r["stay_id"]: r["age"] for r in study["detail"].collect()}
    stays = {r["stay_id"] for r in rows}
    assert stays and all(ages[s] >= 18 for s in stays)
    for stay in stays:
        own = sorted((r for r in rows if r["stay_id"] == stay), key=lambda r: r["charttime"])
        assert len({r["stage"] for r in own}) == 1 and len({r["split"] for r in own}) == 1
        steps = [(b["charttime"] - a["charttime"]).total_seconds() for a, b in zip(own, own[1:])]
        assert set(steps) <= {6 * 3600}
    train = [r for r in rows if r["split"] == "train"]
    for column in made.scaled:
        values = [r[column] for r in train]
        assert min(values) == 0.0 and max(values) <= 1.0
    assert {r["vent"] for r in rows} <= {0, 1}


def test_continuous_keeps_rows_after_onset(study):
    first, continuous = prepare(study).rows, prepare(study, Settings(target="continuous")).rows
    assert continuous.count() >= first.count()
    assert first.select("stay_id").distinct().count() == continuous.select("stay_id").distinct().count()


@pytest.mark.parametrize("changes", [{"most_common": True}, {"impute": "entity"}, {"impute": "column"}, {"fit_on": "all"}, {"stage_threshold": None, "target": "continuous"}])
def test_variants_run(study, changes):
    made = prepare(study, replace(Settings(), **changes))
    assert made.rows.filter("stage is null").count() == 0 and made.rows.count() > 0


def test_minimal_feature_set(study):
    made = prepare({n: study[n] for n in ("stages", "labs", "detail")})
    assert made.features == ["creat", "uo_rt_12hr", "uo_rt_24hr", "uo_rt_6hr"]
    assert made.rows.count() > 0


def test_unknown_choices_are_rejected(study):
    for changes in ({"target": "x"}, {"impute": "x"}):
        with pytest.raises(ValueError):
            prepare(study, replace(Settings(), **changes))


def test_baselines_and_report(study):
    from wardline.plans.study import baseline_predictions, flat_vectors, report
    from wardline.sources.tables import cut_lineage

    settings = Settings(holdout=0.5)
    made = prepare(study, settings)
    flat = flat_vectors(made, settings)
    longest = max(r["count"] for r in made.rows.groupBy("stay_id").count().collect())
    assert flat.first()["features"].size == longest * len(FEATURES)
    small = {"logistic": {"max_iter": 5}, "boosted": {"trees": 2, "depth": 2}, "forest": {"trees": 3, "depth": 3}}
    pred = cut_lineage(baseline_predictions(flat, settings, **small))
    frames = report(pred)
    tested = flat.filter("split = 'test'").count()
    assert tested and pred.count() == 3 * tested
    assert frames["scores"].count() == 15 and frames["confusion"].count() == 12
    assert {r["model"] for r in frames["histogram"].collect()} == {"logistic", "boosted", "forest"}


def test_continuous_predictions(study):
    from wardline.plans.study import continuous_predictions

    settings = Settings(target="continuous", holdout=0.5)
    made = prepare(study, settings)
    pred = continuous_predictions(made, settings, max_iter=5)
    assert pred.count() == made.rows.filter("split = 'test'").count()
    assert pred.filter("prob < 0 or prob > 1 or prob is null").count() == 0
