from cinespark.operators.counting import share_of_total, with_group_count  # noqa: F401
from cinespark.operators.paging import page_after, top_k  # noqa: F401
from cinespark.operators.ranking import dense_rank_desc  # noqa: F401
from cinespark.operators.salting import salted_join  # noqa: F401
from cinespark.operators.reshape import explode_items, one_hot  # noqa: F401
