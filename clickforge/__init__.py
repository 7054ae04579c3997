"""clickforge: click-log feature engineering and modelling on Spark.

Features are declared as data (``plans.specs.FeatureSpec``) and compiled to
DataFrame plans (``plans.features.build_features``).
"""

__version__ = "0.1.0"
