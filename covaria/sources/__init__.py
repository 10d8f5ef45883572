from covaria.sources.catalog import (  # noqa: F401
    ENTITY_CATALOG,
    SAMPLE_CATALOG,
    Feature,
    FeatureCatalog,
    Resolved,
)
from covaria.sources.categories import CATEGORY_BYTES, UNKNOWN_CATEGORY, element_categories  # noqa: F401
from covaria.sources.tables import (  # noqa: F401
    POSITION,
    read_entities,
    read_pairs,
    read_samples,
    read_table,
    split_label,
)
