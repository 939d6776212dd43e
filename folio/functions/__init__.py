"""Column-level operators: URL (U1-U9, U16) and text."""

from folio.functions.urls import (  # noqa: F401
    classify_link, feed_post_id, feed_url, host_first_label, image_local_path,
    is_absolute_url, meta_slug, page_key, url_canonical, url_domain, url_filename,
    url_host, url_path, url_scheme, url_slug,
)
from folio.functions.text import (  # noqa: F401
    article_key, clean_markdown, content_corruption_reason, feed_date_atom,
    feed_date_rss, front_matter, is_short_error_page, kebab_key_line, strip_ws,
    yaml_scalar,
)
