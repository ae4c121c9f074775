from tricycle.plans.bitmap import BITMAP_BITS, bits_for, key_bitmap, maybe_among
from tricycle.plans.order import numbered
from tricycle.plans.report import RunCounters, explain_text, noted, with_metrics
from tricycle.plans.shared import materialize, shared_path
from tricycle.plans.skew import expand_copies, hot_keys, looked_up
from tricycle.plans.strategy import STRATEGIES, hinted, resolve

__all__ = [
    "BITMAP_BITS",
    "STRATEGIES",
    "RunCounters",
    "bits_for",
    "expand_copies",
    "explain_text",
    "hinted",
    "hot_keys",
    "key_bitmap",
    "looked_up",
    "materialize",
    "maybe_among",
    "noted",
    "numbered",
    "resolve",
    "shared_path",
    "with_metrics",
]
