from candela.functions.scalar import (  # noqa: F401
    bucket,
    market_cap_category,
    round4,
    safe_div,
)
