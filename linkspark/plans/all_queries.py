"""Import every query module so that each registers its queries."""

from . import q_scoring  # noqa: F401
from . import q_retrieval  # noqa: F401
from . import q_recovery  # noqa: F401
from . import q_runs, q_curate  # noqa: F401,E401
from . import q_search  # noqa: F401
from . import q_chat  # noqa: F401
from . import q_stream  # noqa: F401
from . import q_catalog  # noqa: F401
from . import q_io  # noqa: F401
