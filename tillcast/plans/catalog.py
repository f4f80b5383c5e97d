"""All registered queries and the SQL they must agree with."""

from tillcast.plans import (
    catalog_features, catalog_models, catalog_recovery, catalog_requests,
    oracle_features, oracle_models, oracle_recovery, oracle_requests,
)

QUERIES = {
    **catalog_features.QUERIES, **catalog_recovery.QUERIES, **catalog_models.QUERIES, **catalog_requests.QUERIES,
}
SQL = {**oracle_features.SQL, **oracle_recovery.SQL, **oracle_models.SQL, **oracle_requests.SQL}
