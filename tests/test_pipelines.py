import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import samples as S
from tidemark.plans import pipelines as PL

SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_train_then_forecast(spark, tmp_dir):
    fact = PL.build_feature_table(spark, SF, os.path.join(tmp_dir, "fact"))
    spec = S.FeatureSpec()
    out = PL.train(fact, spec, champion={"rmse": 1e9}, export_path=os.path.join(tmp_dir, "export"))
    assert out["train_end"] <= out["val_end"]
    assert out["metrics"]["n"] > 0 and out["promote"]
    reg = PL.train(fact, spec, version="v1")
    assert reg["promote"] and reg["registry"].where("status = 'active'").count() == 1
    rows = PL.daily_forecast(fact, out["model"], "v1", os.path.join(tmp_dir, "forecast"), spec=spec,
                             null_threshold=0.75)  # desk flows miss 73 % of the newest day in the proxies
    published = spark.read.parquet(os.path.join(tmp_dir, "forecast"))
    assert published.count() == rows.count() > 0
    newest = fact.select(F.max("trading_date")).first()[0]
    assert published.select(F.min("trading_date")).first()[0] > newest
