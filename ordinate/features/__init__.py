from ordinate.features.spec import FeatureSpec, default_dimension, feature_spec
from ordinate.features.steps import Scaler, scaler_min_max, scaler_standard
from ordinate.features.transform import FittedSpec, use_spec
