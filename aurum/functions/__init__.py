from aurum.functions.columns import *  # noqa: F401,F403
from aurum.functions.privacy import apply_policy, mask_email, mask_phone, salted_hash  # noqa: F401
