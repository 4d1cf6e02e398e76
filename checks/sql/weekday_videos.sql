-- Videos published on each day of the week.

SELECT day_of_week, count(*) AS videos -- one fact row is one video
FROM fact_video_performance
JOIN dim_date USING (date_id)
GROUP BY day_of_week
