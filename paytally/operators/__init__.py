"""The metrics, the user dimension and the key checks at load time."""

from paytally.operators.activity import (
    canonical_pairs,
    net_spending,
    pair_activity,
    receiver_activity,
    receiver_keys,
    sender_activity,
    sender_keys,
    signed_legs,
    user_day_totals,
)
from paytally.operators.keys import first_per_key, keep_known_users, new_keys_only
from paytally.operators.users import user_mentions, users_dim

__all__ = [
    "canonical_pairs",
    "first_per_key",
    "keep_known_users",
    "net_spending",
    "new_keys_only",
    "pair_activity",
    "receiver_activity",
    "receiver_keys",
    "sender_activity",
    "sender_keys",
    "signed_legs",
    "user_day_totals",
    "user_mentions",
    "users_dim",
]
