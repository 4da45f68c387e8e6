"""Sources: landing, paginated pages, rescue reads."""
