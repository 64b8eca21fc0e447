"""All registered queries and the SQL they are checked against."""

from cellpulse.catalog.evaluation_queries import EVALUATION
from cellpulse.catalog.evaluation_sql import EVALUATION_SQL
from cellpulse.catalog.forecast_queries import FORECAST
from cellpulse.catalog.forecast_sql import FORECAST_SQL
from cellpulse.catalog.model_queries import MODELS
from cellpulse.catalog.model_sql import MODEL_SQL
from cellpulse.catalog.monitoring_queries import MONITORING
from cellpulse.catalog.monitoring_sql import MONITORING_SQL
from cellpulse.catalog.neighbor_queries import NEIGHBORS
from cellpulse.catalog.neighbor_sql import NEIGHBORS_SQL
from cellpulse.catalog.stats_queries import STATS
from cellpulse.catalog.stats_sql import STATS_SQL
from cellpulse.catalog.streaming_queries import STREAMING
from cellpulse.catalog.streaming_sql import STREAMING_SQL

QUERIES = {**MONITORING, **FORECAST, **STATS, **EVALUATION, **NEIGHBORS, **MODELS,
           **STREAMING}
ORACLES = {**MONITORING_SQL, **FORECAST_SQL, **STATS_SQL, **EVALUATION_SQL, **NEIGHBORS_SQL,
           **MODEL_SQL, **STREAMING_SQL}
