"""The saved-model query covers the calibrated model, and the training flow is registered."""

import pytest

import __spark_entry__ as entry
from readgrade.operators import classifier as CL

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name, reached", [("ml17_saved_model", {"calibrate"}), ("ml20_training_flow", {"train_and_save"})])
def test_registered_and_reaching_the_calibrated_model(name, reached, spark, sf, monkeypatch):
    class Reached(Exception):
        pass

    def stop(*_, **__):
        raise Reached

    for f in reached:
        monkeypatch.setattr(CL, f, stop)
    monkeypatch.setattr(CL, "fit", lambda *_, **__: None)
    with pytest.raises(Reached):
        QUERIES[name](spark, sf)
    assert "AS same" in ORACLES[name]
