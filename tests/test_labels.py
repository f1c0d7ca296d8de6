import pytest

from cohortloom.functions.labels import label, label_policy_table


@pytest.mark.parametrize(
    "policy, expected", [("main", 1), ("responder", None), ("portal", None), ("recist", None)]
)
def test_stable_disease(evaluate, policy, expected):
    assert evaluate(lambda c: label(c, policy), "SD") == [expected]


def test_main(evaluate):
    got = evaluate(lambda c: label(c, "main"), " pd ", "Partial Response", "NE", None, "")
    assert got == [0, 1, None, None, None]


def test_responder(evaluate):
    assert evaluate(lambda c: label(c, "responder"), "LR", "sr", "resistant", "PD") == [1, 0, 0, None]


def test_portal_rule_order(evaluate):
    got = evaluate(
        lambda c: label(c, "portal"), "NO PROGRESSION", "0:CENSORED", "1:DECEASED", "0:LIVING", "0:DiseaseFree",
        "1:Recurred/Progressed", "yes", "No",
    )
    assert got == [0, 1, 0, None, 1, 0, 1, 0]


def test_recist(evaluate):
    got = evaluate(
        lambda c: label(c, "recist"), "CR", "near complete", "Progressing", "stable", "PROGRESSION", "incomplete progress"
    )
    assert got == [1, 1, 0, None, 0, 1]


def test_policy_is_named(evaluate):
    with pytest.raises(KeyError):
        evaluate(lambda c: label(c, "default"), "CR")


def test_policy_table(spark):
    table = label_policy_table(spark)
    assert table.filter("policy = 'portal' and match_kind = 'contains' and priority = 1").first().token == "PROGRESSION"
