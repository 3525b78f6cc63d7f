from trueledger.functions.finance import (  # noqa: F401
    VARIANCE_BANDS,
    as_of_date,
    money,
    ratio,
    safe_percent,
    status_below,
    status_exact,
    variance_band,
)
from trueledger.functions.hashing import portable_hashes, row_hash  # noqa: F401
