"""Feature selectors. All return the features to drop and a report table."""

from featurelab.operators.selectors.adversarial import AdversarialSettings, drift_auc, drop_adversarial
from featurelab.operators.selectors.base import Selector, SelectorResult
from featurelab.operators.selectors.correlation import CorrelationSettings, drop_correlated
from featurelab.operators.selectors.forward import ForwardRule, ForwardSettings, select_forward
from featurelab.operators.selectors.noise import NoiseSettings, select_noise
from featurelab.operators.selectors.permutation import PermutationSettings, select_permutation

__all__ = [
    "AdversarialSettings",
    "CorrelationSettings",
    "ForwardRule",
    "ForwardSettings",
    "NoiseSettings",
    "PermutationSettings",
    "Selector",
    "SelectorResult",
    "drift_auc",
    "drop_adversarial",
    "drop_correlated",
    "select_forward",
    "select_noise",
    "select_permutation",
]
