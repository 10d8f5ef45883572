from covaria.functions.exprs import (  # noqa: F401
    INFINITY,
    argmax_first,
    clean_value,
    column,
    display_number,
    display_percent,
    finite,
    formula_tokens,
    join_names,
    safe_division,
    split_names,
    total,
)
