"""listinglake: listing-style data as Spark jobs, from landed responses to a star."""
