from cinespark.functions.columns import (  # noqa: F401
    FILL_VALUE,
    SENTINEL,
    age,
    decade,
    decimal_comma_text,
    decimal_comma_to_double,
    feature_name,
    feature_name_py,
    genre_items,
    sentinel_to_null,
    sex_label,
    sexe,
)
