"""Published results: a coefficient table, and the screening of a twelve-row survey."""

import pytest
from pyspark.sql import functions as F

from civicframe.operators import prep, regression

# Education and income of 95 people.
PEOPLE = [
    (4, 91850.6003396357), (2, 65590.0683733076), (2, 101928.528571763), (3, 74700.1293124296), (3, 81779.6089141165), (2,
    89233.133441103), (4, 98308.2580828661), (4, 93621.4546497834), (2, 380000.0), (2, 51661.8228486567), (1, 37979.5404903462), (2,
    51274.3976762946), (3, 80546.5601037182), (4, 80305.9777326539), (5, 100212.61036968), (1, 91205.9494298705), (2,
    69358.2717980227), (3, 79530.4803404073), (3, 64593.0259385943), (5, 91497.5680729414), (2, 82791.0531963702), (3,
    77144.3704704643), (3, 109868.723173647), (2, 42774.6392282968), (4, 85140.7548523422), (1, 52322.3933310994), (3,
    67731.2875889187), (4, 83596.7285245442), (4, 93411.8693820664), (4, 91813.9306120977), (1, 106616.38661946), (5,
    91916.0405826482), (2, 50165.9318615143), (3, 88976.3048845731), (1, 31648.1096950039), (3, 60834.8036349684), (5,
    97315.3779364966), (1, 56369.7483071369), (1, 450000.0), (5, 104246.13749926), (4, 80061.4087654162), (3, 101212.86086235), (4,
    93862.4126354497), (4, 76767.4092776444), (1, 600000.0), (5, 97688.6994582799), (4, 105845.34210596), (4, 78382.9264084716), (4,
    85283.0990061573), (3, 75186.5745874412), (3, 84831.8086021561), (4, 84751.2009528065), (4, 83094.2709365691), (4,
    88934.0475961598), (4, 67793.1479127974), (1, 80949.3413968344), (3, 52857.3052989119), (3, 85571.3910029978), (3,
    70844.2494677175), (5, 117150.86064078), (1, 420000.0), (3, 76058.1696686278), (5, 107774.728965377), (4, 87083.8070064885), (3,
    73205.0512552918), (3, 85443.7230370722), (5, 102180.711678726), (5, 108397.162169621), (3, 73172.5455971275), (5,
    100610.088481175), (3, 76496.159551182), (3, 85796.5751399305), (1, 500000.0), (2, 64586.1668877101), (3, 90202.0379083348), (1,
    68290.7267430746), (2, 30528.4842803068), (3, 96220.5653189535), (5, 109752.736268736), (2, 67645.1766581312), (3,
    64267.376954226), (3, 70369.297839581), (2, 26688.7064486005), (5, 99325.0494593596), (1, 82733.7279095406), (5, 105115.50712937),
    (4, 73202.6724390728), (3, 45180.8375734795), (4, 87286.002783243), (4, 82445.3431784502), (2, 73217.3398654803), (3,
    85662.7897105932), (4, 84208.7758391789), (3, 85040.3403395242), (4, 94173.0955224557),
]

# Fixed values: (term, estimate, standard error, p value) of the three models on them.
LINEAR = [("Intercept", 156078.70840754668, 24680.659182459774, 8.78938264601497e-9), ("education", -17683.057041644966, 7360.934125380611, 0.018279893341792076)]
QUADRATIC = [("Intercept", 294363.3908241346, 46451.13066901186, 8.539010428630342e-9), ("education", -129017.98929667147, 33069.69060597041, 1.8183390202841507e-4),
             ("squared", 18556.268836996278, 5388.0973805886215, 8.650226573977849e-4)]
LOG = [("Intercept", 11.34246061307993, 0.1369339080787717, 6.1617127570007e-89), ("education", 0.003864400109736875, 0.040840135972344996, 0.9248181676659915)]

# Platform, seconds, consent, age, gender, party, attention answer; the four policy answers of a row are equal.
ANSWERS = [
    ("R_001", "Prolific", 255, "Yes", "34", "Man", "Democrat", "Strongly disagree", "Agree"),
    ("R_002", "Prolific", 55, "Yes", "29", "Woman", "Independent", "Strongly disagree", "Agree"),
    ("R_003", "Prolific", 522, "Yes", "41", "Woman", "Republican", "Strongly disagree", "Strongly agree"),
    ("R_004", "Prolific", 149, "Yes", "", "Man", "Democrat", "Agree", "Agree"),
    ("R_005", "MTurk", 132, "Yes", "22", "Nonbinary", "Independent", "Strongly disagree", "Agree"),
    ("R_006", "MTurk", 138, "No", "27", "Woman", "Democrat", "Strongly disagree", "Agree"),
    ("R_007", "MTurk", 55, "Yes", "18", "Man", "", "Agree", "Agree"),
    ("R_008", "MTurk", 47, "Yes", "19", "", "Republican", "Strongly disagree", "Agree"),
    ("R_009", "DepartmentPool", 396, "Yes", "45", "Woman", "Democrat", "Strongly disagree", "Strongly agree"),
    ("R_010", "DepartmentPool", 97, "Yes", "38", "Man", "Independent", "Strongly disagree", "Agree"),
    ("R_011", "DepartmentPool", 163, "Yes", "33", "Prefer not to say", "Republican", "Strongly disagree", "Agree"),
    ("R_012", "DepartmentPool", 465, "Yes", "Prefer not to say", "Woman", "Independent", "Strongly disagree", "Agree"),
]
MISSING = ["", "Prefer not to say"]


@pytest.mark.parametrize("log,terms,expected", [(False, 1, LINEAR), (False, 2, QUADRATIC), (True, 1, LOG)])
def test_coefficient_table(spark, log, terms, expected):
    df = spark.createDataFrame(PEOPLE, "education int, income double")
    x = {"education": F.col("education"), "squared": F.col("education") * F.col("education")}
    y = F.log("income") if log else F.col("income")
    got = {r["term"]: r for r in regression.ols(df, y, dict(list(x.items())[:terms])).collect()}
    assert len(got) == len(expected)
    for term, estimate, error, p in expected:
        assert got[term]["estimate"] == pytest.approx(estimate, rel=1e-8)
        assert got[term]["std_error"] == pytest.approx(error, rel=1e-8)
        assert got[term]["p_value"] == pytest.approx(p, rel=1e-6)


def test_survey_screening(spark):
    raw = spark.createDataFrame(ANSWERS, "id string, platform string, seconds int, consent string, age string, gender string, party string, attention string, policy string")
    wide = raw.select("*", *[F.col("policy").alias(f"q{k}") for k in range(1, 5)]).drop("policy")
    clean = prep.recode_missing(wide, {c: MISSING for c in ("age", "gender", "party")})
    items = [f"q{k}" for k in range(1, 5)]
    flagged = prep.quality_flags(clean, {
        "fast": F.col("seconds") < 120, "inattentive": prep.differs("attention", "Strongly disagree"), "no_consent": prep.differs("consent", "Yes"),
        "straight": prep.all_equal(*items), "missing_high": prep.missing_share("age", "gender", "party", *items) > 0.25})
    share = prep.missing_share("age", "gender", "party", *items)
    rows = {r["id"]: r for r in flagged.withColumn("share", share).collect()}
    hits = lambda flag: [i for i, r in sorted(rows.items()) if r[flag]]
    assert hits("fast") == ["R_002", "R_007", "R_008", "R_010"]
    assert hits("inattentive") == ["R_004", "R_007"]
    assert hits("no_consent") == ["R_006"]
    assert len(hits("straight")) == 12 and hits("missing_high") == []
    assert {i: r["share"] for i, r in rows.items() if r["share"]} == pytest.approx(dict.fromkeys(["R_004", "R_007", "R_008", "R_011", "R_012"], 1 / 7))
    kept = flagged.filter(~prep.any_flag("fast", "inattentive", "no_consent", "missing_high"))
    assert sorted(r["id"] for r in kept.select("id").collect()) == ["R_001", "R_003", "R_005", "R_009", "R_011", "R_012"]
    shares = flagged.groupBy("platform").agg(F.avg(F.col("fast").cast("int")).alias("fast"), F.avg(F.col("inattentive").cast("int")).alias("inattentive"))
    assert {r["platform"]: (r["fast"], r["inattentive"]) for r in shares.collect()} == {"Prolific": (0.25, 0.25), "MTurk": (0.5, 0.25), "DepartmentPool": (0.25, 0.0)}
    scored = kept
    for q in items:
        scored = prep.map_values(scored, q, {"Strongly agree": 5, "Agree": 4}, f"{q}_n")
    scale = scored.withColumn("scale", prep.row_mean(*[f"{q}_n" for q in items]))
    by_party = scale.groupBy("party").agg(F.count("scale").alias("n"), F.avg("scale").alias("mean"), F.median("scale").alias("median"))
    assert {r["party"]: tuple(r)[1:] for r in by_party.collect()} == {"Democrat": (2, 4.5, 4.5), "Republican": (2, 4.5, 4.5), "Independent": (2, 4.0, 4.0)}
