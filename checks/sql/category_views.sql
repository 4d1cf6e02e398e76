-- Views and likes of each listed category.
-- Runs over the registered warehouse views.

WITH per_category AS (
    SELECT category_id, sum(views) AS views, sum(likes) AS likes
    FROM fact_video_performance
    GROUP BY category_id
)
SELECT c.category_name, p.views, p.likes
FROM per_category p
JOIN dim_category c USING (category_id);
