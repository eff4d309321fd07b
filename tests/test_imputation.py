"""Imputation against a plain Python computation on a small network with every fallback level."""

from __future__ import annotations

import datetime as dt
import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from heatherd.operators import coverage, fit, frame, holdout, impute, stations
from heatherd.plans import imputation, work

HOURS = 4
MIN_SAMPLES = 40
HISTORY = f"cd_estacao string, data string, hora_utc string, {frame.TEMPERATURE_COLUMN} string, {frame.HUMIDITY_COLUMN} string"


def build_network():
    """A1 complete, A2 with one sparse month, A3 with few hours (global level), A4 never observed,
    A5 with a constant predictor, A6 starting late."""
    rng = random.Random(7)
    grid, history = [], []
    days = [dt.date(y, m, d) for y in (2001, 2002) for m in (1, 2) for d in range(1, 26)]
    for s in range(1, 7):
        code = f"A00{s}"
        for day in days:
            for hour in range(HOURS):
                season = 20 + 5 * math.sin(day.timetuple().tm_yday / 58) + hour
                t2m = 20.0 if s == 5 else season + rng.gauss(0, 1)
                rh2m = 60 - hour + rng.gauss(0, 5)
                grid.append((code, day.isoformat(), hour, t2m if rng.random() > 0.02 else None, rh2m))
                seen = {1: 0.9, 2: 0.9 if day.month == 1 else 0.1, 3: 0.03, 4: 0.0, 5: 0.9, 6: 0.9 if day.year > 2001 else 0.0}[s]
                if rng.random() < seen:
                    t = 99.0 if rng.random() < 0.03 else 1.1 * season - 1 + rng.gauss(0, 1) + s
                    h = 70 - hour + rng.gauss(0, 4)
                    text = (code, day.isoformat(), f"{hour:02d}00 UTC", f"{t:.2f}".replace(".", ","), f"{h:.2f}".replace(".", ","))
                    history += [text] * rng.choice([1, 1, 1, 2])
    history.append(("A001", "2001/01/01", "0000 UTC", "20", "50"))
    history.append(("Z999", "2001-01-01", "0000 UTC", "20", "50"))
    rng.shuffle(grid), rng.shuffle(history)
    return grid, history


GRID, RAW = build_network()


def plain_frame():
    cells = {}
    for code, day, hour, t, h in RAW:
        t, h = float(t.replace(",", ".")), float(h.replace(",", "."))
        cells.setdefault((code, day, int(hour[:2])), []).append((t if -10 <= t <= 50 else None, h if 0 <= h <= 100 else None))

    def mean(values):
        values = [v for v in values if v is not None]
        return sum(values) / len(values) if values else None

    rows = []
    for code, day, hour, t2m, rh2m in GRID:
        seen = cells.get((code, day, hour), [])
        rows.append({"code": code, "day": day, "hora": hour, "mes": int(day[5:7]), "ano": int(day[:4]), "t2m": t2m, "rh2m": rh2m,
                     "temp": mean([s[0] for s in seen]), "rh": mean([s[1] for s in seen])})
    return rows


def plain_stats(rows, x, y):
    pairs = pd.DataFrame([(r[x], r[y]) for r in rows if r[x] is not None and r[y] is not None], columns=["x", "y"])
    if not len(pairs):
        return None
    return {"n": len(pairs), "mx": pairs.x.mean(), "my": pairs.y.mean(), "sx": pairs.x.std(), "sy": pairs.y.std(), "r": pairs.x.corr(pairs.y)}


def plain_correction(rows, train, method, everything=None):
    """(code, month) -> (level, function) for both variables, with the cascade written out."""
    everything = train if everything is None else everything
    fitted = {}
    for v, (x, y) in fit.VARIABLES.items():
        for code, mes in {(r["code"], r["mes"]) for r in rows}:
            cell = plain_stats([r for r in train if r["code"] == code and r["mes"] == mes], x, y)
            station = plain_stats([r for r in train if r["code"] == code], x, y)
            ok = [s and s["n"] >= MIN_SAMPLES and s["sx"] > 0 for s in (cell, station)]
            level, chosen = ("cell", cell) if ok[0] else ("station", station) if ok[1] else ("global", plain_stats(everything, x, y))
            fitted[v, code, mes] = level, chosen
    low_high = {"temp": (-10, 50), "rh": (0, 100)}

    def apply(r, v):
        level, p = fitted[v, r["code"], r["mes"]]
        value = r[fit.VARIABLES[v][0]]
        if value is None or p is None:
            return None
        slope = (p["r"] if method == "linear" else 1) * p["sy"] / p["sx"]
        value = p["my"] + slope * (value - p["mx"])
        return value if low_high[v][0] <= value <= low_high[v][1] else None

    return fitted, apply


@pytest.fixture(scope="module")
def tables(spark):
    grid = spark.createDataFrame(GRID, "cd_estacao string, data string, hora bigint, t2m double, rh2m double")
    return grid, spark.createDataFrame(RAW, HISTORY)


@pytest.fixture(scope="module")
def hourly_frame(tables):
    return frame.hourly_frame(tables[0], frame.hourly_observations(tables[1])).persist()


def close(a, b):
    return (a is None and b is None) or (a is not None and b is not None and a == pytest.approx(b, rel=1e-9, abs=1e-9))


def test_frame_keeps_every_grid_hour(hourly_frame):
    expected = {(r["code"], r["day"], r["hora"]): r for r in plain_frame()}
    rows = hourly_frame.collect()
    assert len(rows) == len(GRID)
    for r in rows:
        e = expected[r["cd_estacao"], r["data"], r["hora"]]
        assert close(r["temp"], e["temp"]) and close(r["rh"], e["rh"]) and (r["mes"], r["ano"]) == (e["mes"], e["ano"])


def test_observations_with_grid_keep_every_observation(tables):
    observed = frame.hourly_observations(tables[1])
    assert frame.observations_with_grid(observed, tables[0]).count() == observed.count()


@pytest.mark.parametrize("method", impute.METHODS)
def test_hourly_imputation(hourly_frame, method):
    rows = plain_frame()
    fitted, apply = plain_correction(rows, rows, method)
    assert {level for level, _ in fitted.values()} == {"cell", "station", "global"}
    assert fitted["temp", "A005", 1][0] == "global"  # a constant predictor fits nothing
    expected = {(r["code"], r["day"], r["hora"]): (r, apply(r, "temp"), apply(r, "rh")) for r in rows}
    for r in impute.impute_hourly(hourly_frame, method, MIN_SAMPLES).collect():
        e, t, h = expected[r["cd_estacao"], r["data"], r["hora"]]
        assert close(r["temp_corr"], t) and close(r["rh_corr"], h)
        assert close(r["temp_imp"], t if e["temp"] is None else e["temp"])
        assert r["temp_src"] == ("inmet" if e["temp"] is not None else "nasa" if t is not None else None)
        assert r["rh_src"] == ("inmet" if e["rh"] is not None else "nasa" if h is not None else None)


def test_levels_add_up(hourly_frame):
    levels = fit.fit_levels(fit.cell_sums(hourly_frame)).select("level", "temp.n").groupBy("level").agg(F.sum("n")).collect()
    assert len({r[1] for r in levels}) == 1 and len(levels) == 3


def test_scaling_keeps_mean_and_spread_of_the_fit_hours(hourly_frame):
    wide = hourly_frame.filter("cd_estacao = 'A001' AND mes = 1 AND t2m IS NOT NULL AND temp IS NOT NULL")
    r = impute.correct(wide, fit.fit(wide, min_samples=2)).agg(
        F.avg("temp"), F.avg("temp_corr"), F.stddev("temp"), F.stddev("temp_corr")
    ).collect()[0]
    assert r[0] == pytest.approx(r[1]) and r[2] == pytest.approx(r[3])


def plain_daily(rows, apply):
    groups = {}
    for r in rows:
        groups.setdefault((r["code"], r["day"]), []).append(r)
    out = {}
    for key, hours in groups.items():
        day = {"n_horas": len(hours)}
        for v, name in (("temp", "temp"), ("rh", "umid")):
            filled = [(r[v] if r[v] is not None else apply(r, v)) for r in hours]
            obs = sum(r[v] is not None for r in hours)
            imp = sum(r[v] is None and f is not None for r, f in zip(hours, filled))
            values = [f for f in filled if f is not None]
            day[f"{name}_med"] = sum(values) / len(values) if values else None
            day[f"{name}_ext"] = ((max if v == "temp" else min)(values)) if values else None
            day[f"{name}_origem"] = None if obs + imp == 0 else "inmet" if imp == 0 else "nasa" if obs == 0 else "misto"
            day[f"n_{name}_obs"] = obs
            day[f"{name}_frac"] = imp / (obs + imp) if obs + imp else None
        out[key] = day
    first = {}
    for (code, d), day in out.items():
        if day["temp_origem"] in ("inmet", "misto"):
            first[code] = min(first.get(code, d), d)
    for (code, d), day in out.items():
        if day["temp_origem"] in ("inmet", "misto"):
            day["tipo"] = "observado"
        else:
            day["tipo"] = "backfill" if code not in first or d < first[code] else "gap-fill"
    return out


def itu(t, h):
    return None if t is None or h is None else 0.8 * t + h * (t - 14.3) / 100 + 46.3


def check_daily(rows, expected):
    assert len(rows) == len(expected)
    for r in rows:
        e = expected[r["cd_estacao"], r["data"].isoformat()]
        assert close(r["temp_med"], e["temp_med"]) and close(r["temp_max"], e["temp_ext"])
        assert close(r["umid_med"], e["umid_med"]) and close(r["umid_min"], e["umid_ext"])
        assert close(r["itu_med"], itu(e["temp_med"], e["umid_med"])) and close(r["itu_max"], itu(e["temp_ext"], e["umid_ext"]))
        assert (r["temp_origem"], r["umid_origem"], r["tipo"]) == (e["temp_origem"], e["umid_origem"], e["tipo"])
        assert (r["n_horas"], r["n_temp_obs"], r["n_umid_obs"]) == (e["n_horas"], e["n_temp_obs"], e["n_umid_obs"])
        assert close(r["temp_frac_imp"], e["temp_frac"]) and close(r["umid_frac_imp"], e["umid_frac"])


def test_daily_imputation(hourly_frame):
    rows = plain_frame()
    expected = plain_daily(rows, plain_correction(rows, rows, "scaling")[1])
    daily = impute.impute_daily(hourly_frame, min_samples=MIN_SAMPLES, station_bound=6)
    assert daily.columns == impute.DAILY_COLUMNS + ["tipo"]
    got = daily.collect()
    check_daily(got, expected)
    assert {r["tipo"] for r in got} == {"observado", "gap-fill", "backfill"}
    retyped = impute.add_day_type(daily.drop("tipo")).collect()
    assert sorted(map(tuple, retyped), key=str) == sorted(map(tuple, got), key=str)


def test_results_do_not_depend_on_settings_or_bounds(spark, tables):
    def result(bound):
        f = frame.hourly_frame(tables[0], frame.hourly_observations(tables[1]))
        return sorted(map(str, impute.impute_daily(f, min_samples=MIN_SAMPLES, station_bound=bound).select("cd_estacao", "data", "temp_origem", "tipo", F.round("itu_max", 6)).collect()))

    tuned = result(6)
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "true")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert result(None) == tuned
    finally:
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plain_metrics(pairs):
    pairs = [(t, p) for t, p in pairs if t is not None and p is not None]
    n = len(pairs)
    e = [p - t for t, p in pairs]
    mt, mp = sum(t for t, _ in pairs) / n, sum(p for _, p in pairs) / n
    tot, spread = sum((t - mt) ** 2 for t, _ in pairs), sum((p - mp) ** 2 for _, p in pairs)
    return {"n": n, "rmse": math.sqrt(sum(x * x for x in e) / n), "mae": sum(map(abs, e)) / n, "bias": sum(e) / n,
            "r2": 1 - sum(x * x for x in e) / tot, "var_ratio": math.sqrt(spread / tot)}


def test_hold_out(hourly_frame):
    rows = plain_frame()
    train, test = [r for r in rows if r["ano"] != 2002], [r for r in rows if r["ano"] == 2002]
    _, apply = plain_correction(rows, train, "scaling")
    scored = holdout.score_frame(hourly_frame, [2002], min_samples=MIN_SAMPLES).persist()
    for r in holdout.hourly_errors(scored).collect():
        expected = plain_metrics([(x[r["var"]], apply(x, r["var"])) for x in test])
        assert {m: r[m] for m in holdout.METRICS} == pytest.approx(expected, rel=1e-7)
    codes = hourly_frame.select("cd_estacao").distinct()
    per_station = {(r["cd_estacao"], r["var"]): r for r in holdout.station_errors(scored, codes).collect()}
    assert len(per_station) == 12 and per_station["A004", "temp"]["n"] == 0 and per_station["A004", "temp"]["rmse"] is None
    expected = plain_metrics([(x["rh"], apply(x, "rh")) for x in test if x["code"] == "A001"])
    assert {m: per_station["A001", "rh"][m] for m in holdout.METRICS} == pytest.approx(expected, rel=1e-7)

    days, groups = {}, {}
    for r in test:
        groups.setdefault((r["code"], r["day"]), []).append(r)
    for key, hours in groups.items():
        if all(sum(h[v] is not None for h in hours) >= HOURS for v in ("temp", "rh")):
            t, p = [h["temp"] for h in hours], [x for x in (apply(h, "temp") for h in hours) if x is not None]
            if p:
                days[key] = (max(t), max(p))
    complete = holdout.complete_days(scored, HOURS).persist()
    metrics = {r["var"]: r for r in holdout.daily_errors(complete).collect()}
    assert set(metrics) == set(holdout.DAILY_MEASURES)
    assert {m: metrics["temp_max"][m] for m in holdout.METRICS} == pytest.approx(plain_metrics(days.values()), rel=1e-7)
    flips = holdout.class_flips(complete).collect()[0]
    assert flips["n_dias_completos"] == complete.count() and 0 <= flips["itu_max_class_flip_pct"] <= 100
    paired = holdout.join_days(complete.select("cd_estacao", "data", "itu_med"), holdout.predicted_days(scored).select("cd_estacao", "data", "itu_med"))
    assert {r["itu_med_pred"] for r in paired.collect()} == {r["itu_med_pred"] for r in complete.collect()}
    assert holdout.class_flips(complete.limit(0)).collect()[0]["itu_max_class_flip_pct"] is None
    assert [r["n"] for r in holdout.daily_errors(complete.limit(0)).collect()] == [0] * 4


def network_stations(spark):
    return spark.createDataFrame([(f"A00{s}", -10.0 - s, -40.0) for s in range(1, 8)], "cd_estacao string, vl_latitude double, vl_longitude double")


def network_run(grid, history, registry, staging, **options):
    return imputation.impute_all(grid, history, registry, staging, batch_size=3, min_samples=MIN_SAMPLES, station_bound=7, **options)


def bag(df):
    return sorted(map(str, df.collect()))


def test_resumable_network_run(spark, tables, tmp_path):
    grid, history = tables
    staging, registry = str(tmp_path / "staging"), network_stations(spark)
    rows = [r for r in plain_frame()]
    batches = [{"A001", "A002", "A003"}, {"A004", "A005", "A006"}, {"A007"}]
    expected = {}
    for batch in batches[:2]:
        part = [r for r in rows if r["code"] in batch]
        expected |= plain_daily(part, plain_correction(part, part, "scaling")[1])
    expected = {k: v for k, v in expected.items() if k[0] != "A004"}  # never observed

    folder = imputation.run_folder(staging, "scaling", None, MIN_SAMPLES)

    def runs(*codes):
        state = imputation.Staging(spark, folder).state().filter(F.col("cd_estacao").isin(*codes)).collect()
        return {(r["cd_estacao"], r["cells_run"], r["days_run"]) for r in state}

    first = network_run(grid.filter("cd_estacao <> 'A005'"), history, registry, staging).collect()
    assert {r["cd_estacao"] for r in first} == {"A001", "A002", "A003", "A006"}
    before = runs("A001", "A002", "A003")
    inputs = imputation.station_inputs(imputation.input_sums(grid, history, registry))
    pending = imputation.pending_stations(registry, inputs, imputation.Staging(spark, folder).state())
    assert {r["cd_estacao"] for r in pending.filter("fresh").collect()} == {"A005"}
    check_daily(network_run(grid, history, registry, staging).collect(), expected)
    assert before == runs("A001", "A002", "A003")  # finished stations of another batch are not computed again
    everything = runs(*(f"A00{s}" for s in range(1, 8)))
    check_daily(network_run(grid, history, registry, staging).collect(), expected)
    assert everything == runs(*(f"A00{s}" for s in range(1, 8)))
    live = {r for _, *both in everything for r in both}
    for table in ("cells", "days"):  # what no station refers to is gone
        assert set(imputation.run_names(spark, f"{folder}/{table}")) <= live


def test_resumed_run_of_a_grown_registry(spark, tables, tmp_path):
    """A new first station moves the members of every batch."""
    grid, history = tables
    staging, registry = str(tmp_path / "staging"), network_stations(spark)
    network_run(grid, history, registry.filter("cd_estacao > 'A001'"), staging)
    whole = network_run(grid, history, registry, str(tmp_path / "once"))
    grown = network_run(grid, history, registry, staging)
    assert bag(grown) == bag(whole) and {r["cd_estacao"] for r in grown.collect()} == {"A001", "A002", "A003", "A005", "A006"}
    shrunk = registry.filter("cd_estacao <> 'A002'")
    assert bag(network_run(grid, history, shrunk, staging)) == bag(network_run(grid, history, shrunk, str(tmp_path / "other")))


def test_resumed_run_with_more_days_other_years_and_method(spark, tables, tmp_path):
    grid, history = tables
    staging, registry = str(tmp_path / "staging"), network_stations(spark)
    network_run(grid.filter("data < '2002-01-01'"), history, registry, staging)
    for options in ({}, {"years": (2002, 2002)}, {"method": "linear"}):
        fresh = network_run(grid, history, registry, str(tmp_path / f"fresh{len(str(options))}"), **options)
        assert bag(network_run(grid, history, registry, staging, **options)) == bag(fresh)


def test_changed_values_at_the_same_hours(spark, tables, tmp_path):
    """Content decides, not hours: only what a change reaches is computed again."""
    grid, history = tables
    staging, registry = str(tmp_path / "staging"), network_stations(spark)
    folder = imputation.run_folder(staging, "scaling", None, MIN_SAMPLES)

    def state():
        return {r["cd_estacao"]: r.asDict() for r in imputation.Staging(spark, folder).state().collect()}

    network_run(grid, history, registry, staging)
    first = state()
    one = (F.col("cd_estacao") == "A006") & (F.col("data") == "2002-01-05") & (F.col("hora") == 2)
    warmer = grid.withColumn("t2m", F.when(one, F.col("t2m") + 3).otherwise(F.col("t2m")))
    fresh = bag(network_run(warmer, history, registry, str(tmp_path / "fresh")))
    assert bag(network_run(warmer, history, registry, staging)) == fresh != bag(network_run(grid, history, registry, str(tmp_path / "old")))
    second = state()
    assert second["A006"]["cells_run"] != first["A006"]["cells_run"] and second["A006"]["days_run"] != first["A006"]["days_run"]
    assert {c: s for c, s in second.items() if c < "A004"} == {c: s for c, s in first.items() if c < "A004"}  # another batch
    assert second["A005"]["cells_run"] == first["A005"]["cells_run"]

    # the same number of readings, one swapped for another; and a reading delivered twice
    swapped = history.withColumn(frame.TEMPERATURE_COLUMN, F.when((F.col("cd_estacao") == "A001") & (F.col("data") == "2001-02-03"), "21,5").otherwise(F.col(frame.TEMPERATURE_COLUMN)))
    twice = swapped.union(swapped.filter("cd_estacao = 'A002' AND data = '2001-01-07'").limit(1))
    for readings in (swapped, twice):
        assert bag(network_run(warmer, readings, registry, staging)) == bag(network_run(warmer, readings, registry, str(tmp_path / f"f{readings is twice}")))

    # chosen stations leave the others staged
    before = state()
    network_run(warmer, twice, registry, staging, codes=["A001"])
    assert {c: s for c, s in state().items() if c != "A001"} == {c: s for c, s in before.items() if c != "A001"}


def test_failed_run_leaves_what_was_staged(spark, tables, tmp_path, monkeypatch):
    grid, history = tables
    staging, registry = str(tmp_path / "staging"), network_stations(spark)
    expected = bag(network_run(grid, history, registry, staging))

    def fail(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(imputation.Staging, "publish", fail)
        with pytest.raises(RuntimeError, match="stopped"):
            network_run(grid.withColumn("t2m", F.col("t2m") + 1), history, registry, staging)
    folder = imputation.run_folder(staging, "scaling", None, MIN_SAMPLES)
    assert len(imputation.run_names(spark, f"{folder}/days")) == 2
    assert imputation.staged_days(spark, folder).count() == 600
    assert bag(network_run(grid, history, registry, staging)) == expected
    assert len(imputation.run_names(spark, f"{folder}/days")) == 1  # the rows of the failed run are gone


def test_hours_of_a_run_are_joined_once(spark, tables, tmp_path, monkeypatch):
    """The fit and the days read one stored frame; only stations that a batch moves are joined again."""
    grid, history = tables
    calls, join = [], imputation.hourly_frame
    monkeypatch.setattr(imputation, "hourly_frame", lambda *a: calls.append(1) or join(*a))
    staging, registry = str(tmp_path / "staging"), network_stations(spark)
    network_run(grid, history, registry, staging)
    assert len(calls) == 1
    one = (F.col("cd_estacao") == "A001") & (F.col("data") == "2001-01-05")
    warmer = grid.withColumn("t2m", F.when(one, F.col("t2m") + 3).otherwise(F.col("t2m")))
    again = bag(network_run(warmer, history, registry, staging))
    assert len(calls) == 3  # A001, and A003 that falls back to its batch
    assert again == bag(network_run(warmer, history, registry, str(tmp_path / "fresh")))


def test_counted_parameters_are_broadcast_whatever_the_bound(spark, hourly_frame, tmp_path):
    fit.fit(hourly_frame, min_samples=MIN_SAMPLES).write.parquet(str(tmp_path / "p"))
    parameters = spark.read.parquet(str(tmp_path / "p"))

    def logical(**bounds):
        return impute.correct(hourly_frame, parameters, **bounds)._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in logical(station_bound=18_001, parameter_rows=parameters.count())
    assert "strategy=broadcast" not in logical(station_bound=18_001)


def test_changed_periods_are_told_by_content(spark, tables):
    grid, history = tables
    every = network_stations(spark)
    sums = imputation.input_sums(grid, history, every)
    shuffled = imputation.input_sums(grid.orderBy(F.rand(3)), history.repartition(7), every)
    assert imputation.changed_periods(sums, shuffled).count() == 0
    flipped = grid.withColumns({"t2m": F.when(F.col("t2m").isNull(), F.col("rh2m")).otherwise(F.col("t2m")),
                                "rh2m": F.when(F.col("t2m").isNull(), None).otherwise(F.col("rh2m"))})
    found = imputation.changed_periods(sums, imputation.input_sums(flipped, history.filter("cd_estacao <> 'A002' OR data > '2002'"), every)).collect()
    assert ("A002", "2001", "history", "gone") in {tuple(r) for r in found}
    assert {r["mudanca"] for r in found if r["fonte"] == "grid"} == {"changed"}  # a null that moves to another column counts


def test_observed_stations_come_from_the_fit(spark, hourly_frame):
    one_pass = impute.impute_daily(hourly_frame, min_samples=MIN_SAMPLES, only_observed_stations=True)
    two_passes = stations.observed_only(impute.impute_daily(hourly_frame, min_samples=MIN_SAMPLES))
    exact = [c for c, kind in two_passes.dtypes if kind != "double"]
    assert bag(one_pass.select(exact)) == bag(two_passes.select(exact))
    both = [{(r["cd_estacao"], r["data"]): r["itu_med"] for r in df.collect()} for df in (one_pass, two_passes)]
    assert all(close(value, both[1][day]) for day, value in both[0].items())
    assert "A004" not in {r["cd_estacao"] for r in one_pass.collect()}


def test_years_limit_the_run(spark, tables, tmp_path):
    grid, history = tables
    daily = imputation.impute_all(grid, history, network_stations(spark), str(tmp_path / "s"), years=(2002, 2002), codes=["A001"], min_samples=MIN_SAMPLES)
    assert {(r["cd_estacao"], r["data"].year) for r in daily.select("cd_estacao", "data").distinct().collect()} == {("A001", 2002)}


def test_chosen_stations_share_a_fit_and_all_stay(spark, tables):
    grid, history = tables
    codes = ["A002", "A004", "A002"]
    part = [r for r in plain_frame() if r["code"] in codes]
    daily = imputation.impute_codes(grid, history, codes, min_samples=MIN_SAMPLES).collect()
    check_daily(daily, plain_daily(part, plain_correction(part, part, "scaling")[1]))
    assert {r["cd_estacao"] for r in daily} == {"A002", "A004"}  # A004 never observed


def test_sampled_validation(spark, tables):
    scored = imputation.validate_sample(*tables, network_stations(spark), [2002], n=3, min_samples=MIN_SAMPLES)
    assert {r[0] for r in scored.select("cd_estacao").distinct().collect()} == {"A001", "A003", "A005"}
    assert {r[0] for r in scored.select("ano").distinct().collect()} == {2002}


def test_coverage(hourly_frame):
    daily = impute.impute_daily(hourly_frame, min_samples=MIN_SAMPLES).persist()
    by_station = coverage.coverage_by_station(daily).persist()
    rows = {r["cd_estacao"]: r for r in by_station.collect()}
    assert rows["A004"]["frac_dias_temp_tocada"] == 1.0 and rows["A004"]["dias"] == 100
    overall = coverage.coverage_overall(by_station).collect()[0]
    assert overall["estacoes"] == 6 and overall["dias"] == 600
    assert overall["frac_horas_temp_imp"] == pytest.approx(sum(r["frac_horas_temp_imp"] for r in rows.values()) / 6)
    types = coverage.day_types(daily).collect()
    assert sum(r["dias"] for r in types) == 600 and sum(r["pct"] for r in types) == pytest.approx(100)
    assert [r["dias"] for r in types] == sorted((r["dias"] for r in types), reverse=True)
    assert stations.observed_only(daily).select("cd_estacao").distinct().count() == 5


@pytest.mark.parametrize("n, top, shown", [(25, None, 25), (1_200, None, 1_200), (1_200, 15, 15), (3, 15, 3)])
def test_stations_are_ranked_and_cut_on_request(spark, n, top, shown):
    df = spark.range(n).selectExpr("format_string('S%04d', id) AS cd_estacao", "if(id = 2, null, id / 100) AS frac_horas_temp_imp")
    rows = coverage.most_imputed(df, top).orderBy("posicao").collect()
    assert len(rows) == shown and rows[0]["cd_estacao"] == "S0002" and rows[1]["cd_estacao"] == (f"S{n - 1:04d}" if n > 3 else "S0001")


def test_completeness(spark):
    daily = spark.createDataFrame([("A",), ("A",), ("B",)], "cd_estacao string")
    wanted = spark.createDataFrame([("A",), ("C",), ("C",), ("D",)], "cd_estacao string")
    assert tuple(coverage.completeness(daily, wanted).collect()[0]) == (3, 1, 2)
    assert {r[0] for r in stations.missing_stations(wanted, daily).collect()} == {"C", "D"}
    assert [r[0] for r in coverage.excluded_stations(daily, wanted).collect()] == ["C", "D"]


@pytest.mark.parametrize("size, n", [(5, 12), (12, 12), (13, 12), (100, 7), (671, 12), (29, 28)])
def test_station_sample_is_evenly_spaced(spark, size, n):
    codes = [f"{'AB'[i % 2]}{i:03d}" for i in range(size)]
    df = spark.createDataFrame([(c,) for c in codes], "cd_estacao string")
    ordered = sorted(codes)
    assert [r["cd_estacao"] for r in stations.station_index(df).orderBy("posicao").collect()] == ordered
    expected = ordered if size <= n else [ordered[int(i * (size / n))] for i in range(n)]
    assert sorted(r[0] for r in stations.sample_stations(df, n).collect()) == expected


def test_year_blocks(spark):
    one = spark.createDataFrame([("A001",)], "cd_estacao string")
    plan = [tuple(r) for r in work.year_blocks(one, 2001, 2025, 10).orderBy("inicio").collect()]
    assert plan == [("A001", "2001-01-01", "2010-12-31"), ("A001", "2011-01-01", "2020-12-31"), ("A001", "2021-01-01", "2025-12-31")]
    landed = spark.createDataFrame([plan[1]], "cd_estacao string, inicio string, fim string")
    assert work.missing_blocks(work.year_blocks(one, 2001, 2025, 10), landed).count() == 2
    with pytest.raises(ValueError):
        work.year_blocks(one, 2002, 2001, 1)


PERIODS = "cd_estacao string, inicio string, fim string"


def plain_gaps(plan, landed):
    one, gaps = dt.timedelta(days=1), []
    for code, first, last in plan:
        day, run = dt.date.fromisoformat(first), None
        while day <= dt.date.fromisoformat(last):
            inside = any(c == code and a <= day.isoformat() <= b for c, a, b in landed)
            if not inside and run is None:
                run = day
            if inside and run is not None:
                gaps.append((code, run.isoformat(), (day - one).isoformat()))
                run = None
            day += one
        if run is not None:
            gaps.append((code, run.isoformat(), last))
    return sorted(gaps)


def test_periods_of_any_bounds_are_subtracted(spark):
    plan = [(c, f"{y}-01-01", f"{y + 1}-12-31") for c in "abcde" for y in (2001, 2003)]
    landed = [("a", "2001-01-01", "2010-12-31"), ("b", "2001-03-05", "2001-03-05"), ("b", "2001-03-06", "2002-01-01"), ("b", "2003-12-31", "2004-01-01"),
              ("c", "1990-01-01", "2001-06-30"), ("c", "2001-02-01", "2001-02-03"), ("c", "2001-07-02", "2005-01-01"), ("d", "2002-05-05", "2002-05-04"),
              ("d", "no date", "2002-05-04"), ("z", "2001-01-01", "2001-01-02"), ("a", "2001-01-01", "2010-12-31")]
    found = work.missing_periods(spark.createDataFrame(plan, PERIODS), spark.createDataFrame(landed, PERIODS))
    assert sorted(map(tuple, found.collect())) == plain_gaps(plan, [p for p in landed if p[1] != "no date"])
    nothing = work.missing_periods(spark.createDataFrame(plan, PERIODS), spark.createDataFrame([], PERIODS))
    assert sorted(map(tuple, nothing.collect())) == sorted(plan)
    rng = random.Random(4)
    days = [(dt.date(2001, 1, 1) + dt.timedelta(days=i)).isoformat() for i in range(1_400)]
    landed = [(rng.choice("abc"), days[i], days[i + rng.randint(0, 40)]) for i in (rng.randrange(1_300) for _ in range(60))]
    found = work.missing_periods(spark.createDataFrame(plan, PERIODS), spark.createDataFrame(landed, PERIODS))
    assert sorted(map(tuple, found.collect())) == plain_gaps(plan, landed)
    # ten landed years satisfy a plan of five-year blocks
    ten = spark.createDataFrame([("a", "2001-01-01", "2010-12-31")], PERIODS)
    assert work.missing_periods(work.year_blocks(ten.select("cd_estacao"), 2001, 2010, 5), ten).count() == 0


def test_unknown_method_is_refused(hourly_frame):
    with pytest.raises(ValueError):
        impute.impute_hourly(hourly_frame, "cubic")
