import pytest
from pyspark.sql import functions as F

from tidemark.config import Config
from tidemark.operators.decisions import alert_messages, decide, final_alerts

SCHEMA = """transaction_id string, account_id string, card_id string, ts_ms long, produced_ms long, decided_ms long, amount double, event_type string, channel string, latitude double, longitude double,
    merchant_id string, label int, ml_score double, rule_alerts array<struct<rule_id:string,rule_name:string,severity:string,score:double,details:string>>,
    cep_alerts array<struct<alert_type:string,severity:string,score:double,details:string>>"""


def row(rules=(), cep=(), ml=0.0, label=0):
    score = {"CRITICAL": 0.8}
    return ("TX-001", "ACC-001", None, 1000, 1000, 1100, 100.0, "TRANSFER", "ONLINE", 0.0, 0.0, None, label, ml, [(f"R{i}", "r", s, score.get(s, 0.6), "") for i, s in enumerate(rules)], [("X", s, 0.9, "") for s in cep])


CASES = [
    (row(), "APPROVE", "NONE", 0), (row(label=1), "APPROVE", "NONE", 0), (row(["CRITICAL"]), "BLOCK", "RULES_ENGINE", 1), (row(cep=["CRITICAL"]), "BLOCK", "CEP_ENGINE", 1),
    (row(cep=["HIGH"]), "ALERT", "CEP_ENGINE", 1), (row(ml=0.9), "BLOCK", "ML_SCORING", 1), (row(ml=0.6), "ALERT", "ML_SCORING", 1), (row(ml=0.3), "APPROVE", "NONE", 0),
    (row(["CRITICAL"], ["HIGH"]), "BLOCK", "RULES_ENGINE", 1), (row(["MEDIUM"]), "ALERT", "RULES_ENGINE", 1), (row(ml=0.85), "ALERT", "ML_SCORING", 1), (row(ml=0.5), "APPROVE", "NONE", 0),
    (row(cep=["HIGH"], ml=0.95), "ALERT", "CEP_ENGINE", 1), (row(["MEDIUM"], ml=0.6), "ALERT", "ML_SCORING", 1), (row(ml=None), "APPROVE", "NONE", 0),
]


@pytest.mark.parametrize("given, decision, source, fraud", CASES)
def test_priority(spark, given, decision, source, fraud):
    got = decide(spark.createDataFrame([given], SCHEMA), Config()).first()
    assert (got.decision, got.decision_source, got.is_fraud, got.ground_truth_is_fraud, got.status, got.card_id) == (decision, source, fraud, given[12], "COMPLETED", "")


def test_scores_rules_and_alert(spark):
    made = decide(spark.createDataFrame([row(["MEDIUM", "CRITICAL"], ["HIGH"], 0.7)], SCHEMA), Config())
    got, alert = made.first(), final_alerts(made).first()
    assert (got.combined_score, got.rule_triggered) == (0.9, "R0, R1")
    assert (alert.alert_id, alert.alert_type, alert.severity) == ("FINAL_TX-001", "FINAL_BLOCK", "CRITICAL")
    assert alert.details == "Final decision=BLOCK, source=RULES_ENGINE, combined_score=0.9000, ml_score=0.7000, triggered_rules=R0, R1"
    assert '"alertId":"FINAL_TX-001"' in alert_messages(final_alerts(made)).first().value


def test_approved_rows_raise_nothing(spark):
    assert final_alerts(decide(spark.createDataFrame([row()], SCHEMA), Config())).select(F.count("*")).first()[0] == 0
