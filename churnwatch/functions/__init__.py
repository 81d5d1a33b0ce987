from churnwatch.functions.scalar import (  # noqa: F401
    clip,
    is_yes,
    nan_to_null,
    norm_text,
    np_lerp,
    rnd,
    safe_div,
    strip_ws,
    to_number,
)
