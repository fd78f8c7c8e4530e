"""The indicator files, end to end, against the published joined table and summaries."""

import numpy as np
import pytest

from threadlens.plans.indicators import indicator_summaries, load_indicators
from threadlens.plans.jobs import indicators_job
from threadlens.sources.indicators import read_saved_indicators
from threadlens.sources.results import read_results

MONTHS = "January February March April May June July August September October November December".split()

# The published monthly figures.
CPI = {
    2020: "258.682 259.007 258.165 256.094 255.944 257.217 258.543 259.580 260.190 260.352 260.721 261.564",
    2021: "262.200 263.346 265.028 266.727 268.599 270.955 272.184 273.092 274.214 276.590 278.524 280.126",
}
UNEMPLOYMENT = {
    2020: "3.5 3.5 4.4 14.7 13.2 11.0 10.2 8.4 7.9 6.9 6.7 6.7",
    2021: "6.4 6.2 6.0 6.0 5.8 5.9 5.4 5.2 4.7 4.6 4.2 3.9",
}
DOW = {
    2020: "28,256.03 25,409.36 21,917.16 24,345.72 25,383.11 25,812.88 26,428.32 27,781.70 26,501.60 29,638.64 29,638.64 30,606.48",
    2021: "29,982.62 30,932.37 32,981.55 33,874.85 34,529.45 34,502.51 34,935.47 35,360.73 33,843.92 35,819.56 34,483.72 36,338.30",
}
# Count, mean, std, min, quartiles, max per year.
YEARLY = {
    (2020, "CPI"): [12, 258.83824999999996, 1.777963396954252, 255.944, 257.928, 258.8445, 260.2305, 261.564],
    (2020, "DOW"): [12, 26809.97, 2499.0230395132776, 21917.16, 25402.7975, 26464.96, 28601.6825, 30606.48],
    (2021, "Unemp_Rate"): [12, 5.358333333333334, 0.8317105411394186, 3.9, 4.675, 5.6, 6.0, 6.4],
    (2021, "DOW"): [12, 33965.42083333333, 1880.1490638653602, 29982.62, 33628.3275, 34493.115, 35041.785, 36338.3],
    (2021, "Month"): [12, 6.5, 3.605551275463989, 1, 3.75, 6.5, 9.25, 12],
}


@pytest.fixture(scope="module")
def published(tmp_path_factory):
    at = tmp_path_factory.mktemp("indicators")
    short = [m[:3] for m in MONTHS]
    cpi = ["﻿Prices,,", "Years:,2020 to 2021,", ",,", ",".join(["Year", *short, "HALF1", "HALF2"])]
    cpi += [",".join([str(y), *row.split(), "", ""]) for y, row in CPI.items()]
    jobless = ["﻿Survey,,", ",".join(["Year", *short])]
    jobless += [",".join([str(y), *row.split()]) for y, row in UNEMPLOYMENT.items()]
    dow = ["﻿Monthly index 2013-2022,", "Monthly development,", ",", 'Nov 13,"16,576.66"']
    dow += [f'{m} {y - 2000},"{v}"' for y, row in DOW.items() for m, v in zip(short, row.split())]
    paths = []
    for name, lines in (("cpi", cpi), ("jobless", jobless), ("dow", dow)):
        (at / f"{name}.csv").write_text("\n".join(lines), encoding="utf-8")
        paths.append(str(at / f"{name}.csv"))
    return paths


@pytest.fixture(scope="module")
def indicators(spark, published):
    return load_indicators(spark, *published)


def test_the_job_writes_the_same_months_again(spark, published, indicators, tmp_path):
    for _ in range(2):
        indicators_job(spark, *published, str(tmp_path / "out"))
        found = read_results(spark, str(tmp_path / "out"))
        assert set(found) == {"indicators", "summary_table1", "summary_table2", "plotting"}
        assert sorted(map(tuple, found["indicators"].collect())) == sorted(map(tuple, indicators.collect()))


def test_all_months_match(indicators):
    got = {(r.Year, r.Month): (r.CPI, r.Unemp_Rate, r.DOW) for r in indicators.collect()}
    want = {
        (y, m + 1): (
            float(CPI[y].split()[m]),
            float(UNEMPLOYMENT[y].split()[m]),
            float(DOW[y].split()[m].replace(",", "")),
        )
        for y in CPI
        for m in range(12)
    }
    assert got == want


def test_yearly_summary_matches(indicators):
    rows = indicator_summaries(indicators)["summary_table1"].collect()
    got = {(r.Year, r.measure): [r["count"], r.mean, r.std, r["min"], r.q25, r.q50, r.q75, r["max"]] for r in rows}
    assert len(got) == 8
    for key, want in YEARLY.items():
        assert np.allclose(got[key], want, rtol=1e-12)


def test_plotting_table(indicators):
    rows = indicator_summaries(indicators)["plotting"]
    assert rows.columns == ["date", "variable", "value"] and rows.count() == 48
    assert str(indicators.selectExpr("min(date)").first()[0]) == "2020-01-01"


def test_saved_table_reads_the_same(spark, indicators, tmp_path):
    lines = [",Year,Month,CPI,Unemp_Rate,DOW"]
    for y in CPI:
        for m, month in enumerate(MONTHS):
            values = CPI[y].split()[m], UNEMPLOYMENT[y].split()[m], DOW[y].split()[m]
            lines.append(f'{m},{y},{month},{values[0]},{values[1]},"{values[2]}"')
    (tmp_path / "saved.csv").write_text("\n".join(lines))
    saved = read_saved_indicators(spark, str(tmp_path / "saved.csv"))
    assert sorted(map(tuple, saved.collect())) == sorted(map(tuple, indicators.drop("date").collect()))
