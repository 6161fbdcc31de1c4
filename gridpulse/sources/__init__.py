"""Where rows come from: topics, files, databases, object stores."""
